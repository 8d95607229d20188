"""Licence scan by canonical digests: whole texts are normalised, hashed, and joined to digests of known licences.

Case, punctuation, white space, names of copyright holders and equivalent spellings do not matter; everything else does, so a
match is the licence itself. A holder is named after a copyright sign ("copyright (c)", "©") or after "copyright" or "(c)" and a
year; the name ends with its line or where a licence text begins. Sentences about copyright holders, owners and notices stay. A
document is looked up as a whole and line by line: a file may be a licence, or name one in a notice that fills a line.
Texts are normalised once, with built-in functions, and nothing is shuffled while the known digests can be broadcast.

Null texts have no digest and no licence. A text without any letter or digit has the digest of the empty string, which is no
licence. Rows equal in id and text get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, with_results
from roamsight.llm.licence_texts import KNOWN

#: Spellings that licences use interchangeably, applied in this order to single words.
EQUIVALENT = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
    ("owner", "holder"),
    ("owners", "holders"),
]
#: Typographic marks and the blanks that stand for them.
MARKS = "“”‘’«»–—…•· "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How licence texts and notices go on after the holder's name on one line.
OPENINGS = [
    "all rights reserved",
    "permission is hereby granted",
    "permission to use",
    "redistribution and use",
    "this software is provided",
    "licensed under",
    "released under",
]
#: The holder of the rights, in lower case.
HOLDER = rf"(?:copyright[ \t]*(?:\(c\)|©)|©|(?:copyright|\(c\))[ \t,:]*[0-9]{{4}})[^\n]*?(\n|\z|{'|'.join(OPENINGS)})"
RESERVED = "all rights reserved"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 100_000


def canonical_lines(text: Column) -> Column:
    """Words of the text, one blank between them and around line ends."""
    lowered = F.translate(text, UPPER + MARKS, LOWER + " " * len(MARKS))
    words = F.replace(F.regexp_replace(lowered, HOLDER, " $1"), F.lit(RESERVED), F.lit(" "))
    words = F.replace(F.regexp_replace(words, PUNCTUATION, "  "), F.lit("\n"), F.lit("  \n  "))
    words = F.concat(F.lit("  "), words, F.lit("  "))
    for variant, common in EQUIVALENT:
        words = F.replace(words, F.lit(f" {variant} "), F.lit(f" {common} "))
    return F.regexp_replace(words, " +", " ")


def _joined(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def canonical(text: Column) -> Column:
    """Words of the text, one blank between them."""
    return _joined(canonical_lines(text))


def _sha(words: Column) -> Column:
    return F.sha2(words.cast("binary"), 256)


def digest(text: Column) -> Column:
    return _sha(canonical(text))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(licence, digest) of each known text; the first name counts where two texts are the same."""
    known = spark.createDataFrame([(i, *row) for i, row in enumerate(texts)], "place int, licence string, text string")
    known = known.select("place", "licence", digest(F.col("text")).alias("digest"))
    return known.groupBy("digest").agg(F.min_by("licence", "place").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Docs with ``canonical_sha256``, ``licence`` (of the whole text) and ``line_licences`` (sorted, of single lines).

    ``known`` has one row per digest. It is broadcast up to ``BROADCAST_ROWS`` rows and joined by shuffling beyond.
    """
    words, whole, key = fresh(docs, "canonical_words"), fresh(docs, "whole_digest"), fresh(docs, "text_digest")
    rows = docs.withColumn(words, canonical_lines(F.col(text_col)))
    lines = F.transform(F.array_distinct(F.split(words, "\n", -1)), lambda line: _sha(F.trim(line)))
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found, names = fresh(docs, "line_found"), fresh(docs, "known_names")
    if few:
        # a row with all known digests meets every document; sets of digests are intersected row by row
        listed = known.agg(F.map_from_entries(F.collect_list(F.struct("digest", "licence"))).alias(names))
        rows = rows.crossJoin(F.broadcast(listed))
        met = F.transform(F.array_intersect(lines, F.map_keys(names)), lambda d: F.element_at(names, d))
        rows = rows.withColumns({whole: _sha(_joined(F.col(words))), found: F.array_sort(F.array_distinct(met))}).drop(words, names)
        known = F.broadcast(known)
    else:
        rows = rows.withColumns({whole: _sha(_joined(F.col(words))), key: F.xxhash64(text_col)})
        line = rows.select(F.col(id_col).alias("id"), F.col(key).alias("key"), F.explode(lines).alias("digest"))
        met = line.join(known, "digest").groupBy("id", "key").agg(F.array_sort(F.collect_set("licence")).alias("found"))
        of, of_key = fresh(rows, "line_id"), fresh(rows, "line_key")
        met = met.select(F.col("id").alias(of), F.col("key").alias(of_key), F.col("found").alias(found))
        rows = rows.drop(words).join(met, F.col(id_col).eqNullSafe(F.col(of)) & (F.col(key) == F.col(of_key)), "left")
    names = known.select(F.col("digest").alias(fresh(docs, "known_digest")), F.col("licence").alias(fresh(docs, "known_licence")))
    rows = rows.join(names, F.col(whole) == F.col(names.columns[0]), "left")
    none = F.array().cast("array<string>")
    results = {
        "canonical_sha256": F.col(whole),
        "licence": F.col(names.columns[1]),
        "line_licences": F.when(F.col(text_col).isNotNull(), F.coalesce(found, none)),
    }
    taken = set(results)
    return rows.select(
        *[F.col(f"`{name}`") for name in docs.columns if name.lower() not in taken], *[c.alias(n) for n, c in results.items()]
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    """The canonical form in DuckDB's SQL, with its own rule for holders: a name goes on until the line or the licence says otherwise."""
    sql = f"translate({text}, {_quoted(UPPER + MARKS)}, {_quoted(LOWER + ' ' * len(MARKS))})"
    named = "copyright[ \\t]*[(]c[)]|copyright[ \\t]*©|©|copyright[ \\t,:]*[0-9][0-9][0-9][0-9]|[(]c[)][ \\t,:]*[0-9][0-9][0-9][0-9]"
    goes_on = (
        "all rights reserved|permission is hereby granted|permission to use|redistribution and use"
        "|this software is provided|licensed under|released under"
    )
    sql = f"regexp_replace({sql}, '({named})[^\n]*?(\n|\\z|{goes_on})', ' \\2', 'g')"
    sql = f"replace({sql}, 'all rights reserved', ' ')"
    sql = f"'  ' || regexp_replace({sql}, '[^0-9a-z\\x80-\\x{{10FFFF}}]+', '  ', 'g') || '  '"
    for variant, common in EQUIVALENT:
        sql = f"replace({sql}, ' {variant} ', ' {common} ')"
    return f"trim(regexp_replace({sql}, ' +', ' ', 'g'))"


def oracle(texts: list[tuple[str, str]] = KNOWN) -> str:
    """The registered query in DuckDB's SQL, from the same known texts."""
    rows = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(texts))
    return f"""
        WITH listed(place, licence, text) AS (VALUES {rows}),
        known AS (SELECT {_canonical_sql("text")} AS words, arg_min(licence, place) AS licence FROM listed GROUP BY 1),
        lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL
        ),
        found AS (
            SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names
            FROM (SELECT doc_id, {_canonical_sql("line")} AS words FROM lines) JOIN known USING (words) GROUP BY doc_id
        ),
        whole AS (SELECT doc_id, {_canonical_sql("text")} AS words FROM documents)
        SELECT w.doc_id, sha256(w.words) AS canonical_sha256, k.licence, coalesce(f.names, '') AS line_licences
        FROM whole w LEFT JOIN known k USING (words) LEFT JOIN found f ON f.doc_id = w.doc_id
    """
