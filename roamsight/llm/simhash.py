"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has 64 bits: a bit is one if it is one in more than half of the hashes (XXH64, seed 42) of the
document's word shingles, repeats included. Two fingerprints are linked if at most ``RADIUS`` = 3 bits differ; links
carry over to connected components.

Links are found without comparing pairs. Whoever differs in three bits from a partner differs from it in parity too, so
it is enough that even fingerprints emit all variants within two bits, odd ones all within one bit:

* distance 0: one and the same distinct fingerprint;
* distance 1 or 3 (one even, one odd): the even one walks up to two bits, the odd one the last bit;
* distance 2 (equal parity): both walk one bit.

So linked fingerprints always meet in a variant that at least one of them reaches with one bit. The other way round,
whatever meets a variant that some fingerprint reaches with one bit is at most 1 + 2 = 3 bits away from that
fingerprint: a verified link. Each variant therefore takes its smallest one-bit visitor as centre and links every other
visitor to it. That is one link per visitor instead of all pairs, and it leaves out no connection: visitors of a variant
that nobody reaches within one bit are only linked if another variant shows it.

2,081 variants of a fingerprint are many, so an exact test first sets aside fingerprints that are alone. Three
differing bits leave at most one in one of the two halves; each half is sent with the variants of up to one bit (by
parity again: odd halves walk, even ones wait). Fingerprints that meet another one there, and once more with one of the
four bytes of the other half, go on; all others are further than three bits from any. Variants always meet by shuffle, never by
broadcast; only the 2,080 masks go to all tasks.

Nulls, empty texts and texts of blanks have no shingle and the fingerprint zero, which is linked like any other. Rows
that are equal in all columns get equal results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.llm.common import components, fresh
from roamsight.sources.staging import stage

RADIUS = 3
SEED = 42
CHUNK = 1 << 14

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """Hashes of all word shingles of one UTF-8 text, in chunks; memory is a few times the text's."""
    raw = np.frombuffer(text.lower(), np.uint8)  # bytes.lower() changes A-Z only
    blank = _SPACE[raw]
    edge = np.flatnonzero(np.diff(blank.astype(np.int8), prepend=1, append=1))
    if not len(edge):
        return
    lengths = edge[1::2] - edge[::2]
    ends = np.cumsum(lengths + 1) - 1  # in the normalised text, words are one blank apart
    starts = ends - lengths
    first_blank = blank & ~np.concatenate([[True], blank[:-1]])
    clean = np.where(blank, np.uint8(0x20), raw)[~blank | first_blank].tobytes()
    n = max(1, len(starts) - words + 1)
    last = ends[min(words, len(ends)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        pairs = zip(starts[at : min(at + CHUNK, n)].tolist(), last[at : min(at + CHUNK, n)].tolist(), strict=True)
        yield np.array([digest(clean[a:b], SEED) for a, b in pairs], np.dtype("<u8"))


def majority(chunks: Iterable[np.ndarray]) -> int:
    """The bits that are one in more than half of the hashes, as a signed number."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in chunks:
        n += len(hashes)
        bits = np.unpackbits(hashes[:, None].view(np.uint8), axis=1, bitorder="little")
        for at in range(0, len(bits), 255):  # so many ones fit a byte
            ones += bits[at : at + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int) -> Column:
    """SimHash over shingles of so many words, as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def hashed(texts: pa.Array) -> pa.Array:
        found = [majority(shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else b"", words)) for t in texts]
        return pa.array(found, pa.int64())

    return hashed(text)


def _met(sent: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key some other fingerprint has too."""
    same = Window.partitionBy(*keys)
    both = sent.withColumns({"low": F.min("fingerprint").over(same), "high": F.max("fingerprint").over(same)})
    return both.where("low <> high").drop("low", "high")


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct values of the column ``fingerprint`` that connect all that differ by up to three bits."""
    masks = distinct.sparkSession.range(1).select(
        F.expr("transform(sequence(0, 63), i -> shiftleft(1L, i))").alias("one"),
        F.expr("flatten(transform(sequence(1, 63), i -> transform(sequence(0, i - 1), j -> "
               "shiftleft(1L, i) | shiftleft(1L, j))))").alias("two"),
    )
    masks = F.broadcast(masks)  # 2,080 numbers

    # fingerprints that meet another one in a half of 32 bits with at most one differing bit
    halves = distinct.select(
        "fingerprint",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.expr("fingerprint & 4294967295L").alias("half")),
                F.struct(F.lit(1).alias("side"), F.expr("shiftrightunsigned(fingerprint, 32)").alias("half")),
            )
        ).alias("part"),
    )
    odd = F.expr("bit_count(part.half) % 2 = 1")
    walked = F.expr("array_prepend(transform(sequence(0, 31), i -> part.half ^ shiftleft(1L, i)), part.half)")
    other = F.expr("if(part.side = 0, shiftrightunsigned(fingerprint, 32), fingerprint & 4294967295L)")
    sent = halves.select(
        "fingerprint", "part.side", other.alias("other"), F.explode(F.when(odd, walked).otherwise(F.array("part.half"))).alias("half")
    )
    sent = _met(sent, "side", "half")
    # of the other half's four bytes, three differing bits leave one alone
    octets = F.expr("transform(sequence(0, 3), i -> struct(i as place, shiftright(other, 8 * i) & 255 as octet))")
    sent = _met(sent.select("fingerprint", "side", "half", F.inline(octets)), "side", "half", "place", "octet")
    active = stage(sent.select("fingerprint").distinct(), "near")
    active = active.repartition(int(active.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fingerprint")

    even = F.expr("bit_count(fingerprint) % 2 = 0")
    near = F.expr("array_prepend(transform(one, m -> fingerprint ^ m), fingerprint)")
    far = F.expr("transform(two, m -> fingerprint ^ m)")
    ball = active.crossJoin(masks)
    centres = ball.select("fingerprint", F.explode(near).alias("variant"))
    centres = centres.groupBy("variant").agg(F.min("fingerprint").alias("centre"))
    visits = ball.select("fingerprint", F.explode(F.when(even, F.concat(near, far)).otherwise(near)).alias("variant"))
    # a thousand variants a fingerprint, which Spark sizes as one: by its guess it would broadcast them
    found = visits.hint("merge").join(centres, "variant").where("fingerprint <> centre")
    return found.select(F.col("fingerprint").alias("a"), F.col("centre").alias("b")).distinct()


def memberships(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: ``id``, ``digest`` of the text, ``fingerprint`` and ``component``.

    ``component`` holds the row that stays of each component: the smallest id, and among rows of that id the smallest
    digest. Null ids come last. Everything after the fingerprints works on distinct ones, however many copies they have.
    """
    bits = fingerprint(F.col(text_col), words).alias("fingerprint")
    narrow = stage(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), bits), "fingerprints")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    distinct = stage(narrow.groupBy("fingerprint").agg(F.min(row).alias("first")), "distinct_fingerprints")
    found = links(distinct.select("fingerprint"))
    placed = distinct.join(components(found), F.col("fingerprint") == F.col("node"), "left")
    placed = placed.select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("group"))
    smallest = placed.groupBy("group").agg(F.min("first").alias("component"))
    placed = placed.join(smallest, "group").select("fingerprint", "component")
    return narrow.join(placed, "fingerprint").select("id", "digest", "fingerprint", "component")


def deduplicate(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each component one row stays, as :func:`memberships` names it."""
    members = memberships(docs, words, id_col, text_col)
    stays = members.select("component.id", "component.digest").distinct()
    same, copy = fresh(docs, "text_digest"), fresh(docs, "copy")
    rows = docs.withColumn(same, F.xxhash64(text_col))
    rows = rows.join(stays, rows[id_col].eqNullSafe(stays["id"]) & (rows[same] == stays["digest"]), "left_semi")
    others = [F.xxhash64(f"`{name}`") for name, kind in docs.dtypes if not kind.startswith("map")]
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(id_col, same).orderBy(*others)))
    return rows.where(F.col(copy) == 1).drop(same, copy)
