"""Entry point for spark-submit."""

from roamsight.__main__ import command

if __name__ == "__main__":
    command()
