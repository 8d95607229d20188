"""The jobs: session base, user table, segments, yearly KPIs, retention."""
