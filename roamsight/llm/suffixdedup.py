"""Repeated byte strings by longest-previous-factor arrays over suffix arrays that are dealt out in buckets.

A byte goes if a string of ``length`` bytes that covers it starts somewhere else too: earlier in the corpus with
``keep="first"`` (the first copy stays), anywhere with ``keep="none"``. The corpus has no single suffix array, which would be
many times its size; only the suffixes that can match are sorted, in buckets:

1. Every string of ``length`` bytes has a smallest hash among its grams of ``GRAM`` bytes, equal for equal strings.
   Neighbouring strings mostly share it, so a text falls into runs of some 150 starts; a run goes to the bucket of its
   hash. One row per run, without text, crosses the network.
2. A run whose hash occurs once, in the run and in the corpus, has no match. Runs with equal bytes are copies as a whole
   and are represented by the earliest. Long copies and passages consist of such runs, whatever their number.
3. Where a bucket still holds different runs, mostly the two ends of a shared passage, the bytes of the representatives are
   fetched. Their starts are sorted as suffixes of ``length`` bytes; from the common prefixes of neighbours and the
   previous and next smaller position in that order follows each start's longest previous factor. Where no copy is to
   stay, the longest factor that starts anywhere else is what a start shares with one of its neighbours.
4. A bucket with over ``GROUP`` different runs (a passage in very many different surroundings) is split: its runs are cut at
   starts that the hash of their string picks, one in ``PIECE``, so that inside the passage all are cut alike. Equal pieces
   are copies as a whole; only of different ones, mostly one at either end of the passage, the strings are dealt out by their
   128-bit hashes and matched where they meet. Both are counts combined before the shuffle. Strings that more than ``GROUP``
   different pieces hold go to the tasks, at most ``FREQUENT`` of them (some 10 MB) and the most frequent first, and are
   matched where their pieces lie; all others are matched by a join, in which no key but those beyond ``FREQUENT`` is hot.

Positions are ordered by document id (nulls first), a digest of the text, and offset; rows equal in id and text are
numbered where they meet their result. Matches never cross documents. Null texts count as empty; texts shorter than
``length`` are never touched.

All of this holds for strings of :class:`Unit`: bytes, or words, each as a number of eight bytes. Starts, lengths and spans count
units.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.llm.common import fresh
from roamsight.sources.staging import stage, unstage

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RUN = 512
GROUP = 64
PIECE = 8
FREQUENT = 1 << 15
STARTS = 1 << 15
BLOCK = 1 << 22
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Unit:
    """What strings consist of: ``width`` bytes each; a gram has ``gram`` units, a power of two; ``code`` turns a text into units."""

    width: int
    gram: int
    code: Callable[[bytes], bytes]


def word_hashes(text: bytes) -> bytes:
    """A hash of eight bytes for each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text.split()), "<u8").tobytes()  # splits where WORD does


BYTES = Unit(1, 128, bytes)
WORDS = Unit(8, 8, word_hashes)


def gram_hashes(raw: bytes, unit: Unit = BYTES) -> np.ndarray:
    """A mixed 64-bit hash of the gram at each unit, doubled from what fills a number: one word, or eight bytes."""
    width = 1
    if unit.width == 8:
        x = np.frombuffer(raw, "<u8") * _MIX[2]
    else:
        x = np.frombuffer(raw, np.uint8).astype(np.uint64)
        for width in (1, 2, 4):
            x = (x[:-width] << np.uint64(8 * width)) | x[width:]
        width = 8
    while width < unit.gram:
        x = (x[:-width] * _MIX[0]) ^ ((x[width:] ^ (x[width:] >> np.uint64(29))) * _MIX[1])
        x ^= x >> np.uint64(32)
        width *= 2
    x = x * _MIX[2]
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(coded: bytes, length: int, unit: Unit = BYTES) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first start, number of starts, smallest hash, digest of the string, whether the hash occurs twice) of each run.

    Long texts are worked off in overlapping blocks; a run that a block cuts is two runs, as are runs over ``RUN``.
    """
    w = unit.width
    for base in range(0, len(coded) // w - length + 1, BLOCK):
        part = coded[base * w : (base + BLOCK + length - 1) * w]
        hashes = gram_hashes(part, unit)
        least = sliding_min(hashes, length - unit.gram + 1)
        cuts = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
        values = least[cuts[:-1]].view(np.int64).tolist()
        for at, end, value in zip(cuts[:-1], cuts[1:], values, strict=True):
            for a in range(at, end, RUN):
                n = min(RUN, end - a)
                twice = np.count_nonzero(hashes[a : a + n + length - unit.gram] == least[a]) > 1
                digest = xxhash.xxh3_64_intdigest(part[a * w : (a + n + length - 1) * w])
                yield base + a, n, value, digest - (digest >> 63 << 64), twice


def _runs_of(schema: pa.Schema, length: int, unit: Unit):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, texts = batch.columns
            for low in range(0, len(texts), 256):
                rows, found = [], []
                for i, text in enumerate(texts.slice(low, 256), low):
                    if text.is_valid:
                        mine = list(runs(unit.code(text.as_buffer().to_pybytes()), length, unit))
                        rows += [i] * len(mine)
                        found += mine
                if rows:
                    picked = pa.array(rows, pa.int64())
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(schema)[2:], strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.take(picked), digests.take(picked), *columns], schema=schema)

    return emit


def longest_previous(lcp: list[int], position: list[int]) -> list[int]:
    """For suffixes in order, with lcp[i] shared with the one before: the longest prefix shared with a smaller position.

    The stack holds suffixes whose next smaller position is still to come, each with what it shares with the entry below,
    its previous smaller position.
    """
    found, stack = [0] * len(position), []
    for i, (common, at) in enumerate(zip(lcp, position, strict=True)):
        while stack and position[stack[-1][0]] > at:
            j, below = stack.pop()
            found[j] = max(below, common)
            common = min(below, common)
        stack.append((i, common))
    for j, below in stack:
        found[j] = below
    return found


def match_starts(contents: list[bytes], length: int, first: bool, unit: Unit = BYTES) -> list[np.ndarray]:
    """Which starts of each content have a match: earlier in the given order if ``first``, anywhere otherwise."""
    counts = [len(c) // unit.width - length + 1 for c in contents]
    long = length * unit.width
    windows = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(c, np.uint8), long)[:: unit.width] for c in contents]
    table = np.ascontiguousarray(np.concatenate(windows))
    order = np.argsort(table.view(f"S{long}").ravel(), kind="stable")
    table = table[order]
    differ = table[1:] != table[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), long)
    common = np.concatenate(([0], shared, [0]))
    if first:
        best = np.array(longest_previous(common[:-1].tolist(), order.tolist()))
    else:  # no suffix shares more than a neighbour in the order
        best = np.maximum(common[:-1], common[1:])
    hit = np.zeros(len(table), bool)
    hit[order] = best >= long
    return np.split(hit, np.cumsum(counts)[:-1])


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true entries as (start, end)."""
    edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()
    return list(zip(edge[::2], edge[1::2], strict=True))


def _fetched(schema: pa.Schema, length: int, unit: Unit):
    """The units of small buckets' runs; the others cut into pieces, each with its digest and the 128-bit hashes of its strings."""

    def signed(value: int) -> tuple[int, int]:
        high, tail = value >> 64, value & ((1 << 64) - 1)
        return high - (high >> 63 << 64), tail - (tail >> 63 << 64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                rows, out = [], []
                for i, (text, wanted) in enumerate(zip(part["text"], part["wanted"].to_pylist(), strict=True)):
                    raw, size = unit.code(text.as_buffer().to_pybytes()), unit.width
                    for w in wanted:
                        at, n = w["at"], w["n"]
                        if not w["split"]:
                            out.append((at, n, w["hash"], 0, raw[at * size : (at + n + length - 1) * size], None))
                            rows.append(i)
                            continue
                        strings = [xxhash.xxh3_128_intdigest(raw[a * size : (a + length) * size]) for a in range(at, at + n)]
                        starts = [j for j, one in enumerate(strings) if not j or one % PIECE == 0]
                        for low_, high_ in zip(starts, [*starts[1:], n], strict=True):
                            piece = xxhash.xxh3_128_intdigest(raw[(at + low_) * size : (at + high_ + length - 1) * size])
                            mine = [dict(zip(("hash", "more"), signed(one), strict=True)) for one in strings[low_:high_]]
                            out.append((at + low_, high_ - low_, *signed(piece), None, mine))
                            rows.append(i)
                if rows:
                    picked = pa.array(rows, pa.int64())
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[2:], strict=True)]
                    ids, digests = part["id"].take(picked), part["digest"].take(picked)
                    yield pa.RecordBatch.from_arrays([ids, digests, *columns], schema=schema)

    return emit


def _matched(schema: pa.Schema, length: int, first: bool, unit: Unit):
    """Spans of matching starts, from rows sorted by bucket and position; whole buckets are taken together."""

    def sort(rows: list[dict]) -> pa.RecordBatch:
        out = []
        for row, hit in zip(rows, match_starts([r["content"] for r in rows], length, first, unit), strict=True):
            out += [(row["id"], row["digest"], row["at"] + a, row["at"] + b + length - 1) for a, b in spans(hit)]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        total = 0
        for batch in batches:
            for row in batch.to_pylist():
                if rows and all(row[name] == rows[-1][name] for name in ("id", "digest", "at")):
                    continue  # a row of docs that is repeated as a whole
                if total >= STARTS and row["hash"] != rows[-1]["hash"]:
                    yield sort(rows)
                    rows, total = [], 0
                rows.append(row)
                total += row["n"]
        if rows:
            yield sort(rows)

    return emit


def _looked_up(schema: pa.Schema, length: int, first: bool, frequent: Broadcast):
    """Spans that frequent strings match in pieces, and the pieces' other strings (without ``high``)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], tuple[int, int]] = frequent.value
        for batch in batches:
            rows, out = [], []
            for i, row in enumerate(batch.drop_columns(["id"]).to_pylist()):
                places = [known.get((one["hash"], one["more"])) for one in row["strings"]]
                own, at = row["owner"], row["at"]
                hit = [place is not None and not (first and place == (own, at + j)) for j, place in enumerate(places)]
                mine = [(at + low, at + high + length - 1, None, None) for low, high in spans(np.array(hit, bool))]
                rest = [(at + j, one) for j, (one, place) in enumerate(zip(row["strings"], places, strict=True)) if place is None]
                mine += [(place, None, one["hash"], one["more"]) for place, one in rest]
                out += [(row["digest"], *found) for found in mine]
                rows += [i] * len(mine)
            if rows:
                ids = batch["id"].take(pa.array(rows, pa.int64()))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *columns], schema=schema)

    return emit


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def repeated_spans(docs: DataFrame, length: int, keep: str, id_col: str, text_col: str, unit: Unit = BYTES) -> DataFrame:
    """Spans [low, high) to remove, some of them overlapping: ``id``, ``digest`` of the text, ``low``, ``high``."""
    first = keep == "first"
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    key = texts.select("id", "digest")
    like = lambda *more: key.limit(0).select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in more])
    whole = texts.where(F.octet_length("text") >= length)

    shape = like(("at", "bigint"), ("n", "int"), ("hash", "bigint"), ("bytes", "bigint"), ("twice", "boolean"))
    found = stage(whole.mapInArrow(_runs_of(_arrow(shape), length, unit), shape.schema), "runs")
    buckets = found.groupBy("hash").agg(
        F.count("*").alias("total"), F.min("bytes").alias("low"), F.max("bytes").alias("high"), F.max("twice").alias("twice")
    )
    mixed = (F.col("low") != F.col("high")) | F.col("twice")
    buckets = buckets.where((F.col("total") > 1) | F.col("twice")).select("hash", mixed.alias("mixed"))
    shared = stage(found.join(buckets, "hash"), "shared_runs")
    unstage(found)

    position = F.struct("id", "digest", "at")
    equal = shared.groupBy("hash", "bytes").agg(
        F.count("*").alias("copies"), F.min(position).alias("first"), F.first("n").alias("n"), F.first("mixed").alias("mixed")
    )
    equal = stage(equal, "equal_runs")
    end = F.col("at") + F.col("n") + F.lit(length - 1)
    copies = shared.join(equal.where("copies > 1").select("hash", "bytes", "first"), ["hash", "bytes"])
    if first:
        copies = copies.where(~position.eqNullSafe(F.col("first")))
    copies = copies.select("id", "digest", F.col("at").alias("low"), end.alias("high"))

    # representatives whose starts may match starts of other runs; a run with copies is all matched unless the first stays
    open_ = equal.where("mixed")
    sizes = open_.groupBy("hash").agg(F.count("*").alias("members"))
    wanted = open_.join(sizes, "hash").select(
        "first.*", "n", "hash", (F.col("members") > GROUP).alias("split")
    )
    wanted = wanted.groupBy("id", "digest").agg(F.collect_list(F.struct("at", "n", "hash", "split")).alias("wanted"))
    wanted = wanted.select(F.col("id").alias("wid"), F.col("digest").alias("wdigest"), "wanted")
    fetched = whole.join(
        wanted.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("wid")) & (F.col("digest") == F.col("wdigest"))
    ).select("id", "digest", "text", "wanted")
    strings = "array<struct<hash:bigint,more:bigint>>"
    shape = like(("at", "bigint"), ("n", "int"), ("hash", "bigint"), ("more", "bigint"), ("content", "binary"), ("strings", strings))
    fetched = stage(fetched.mapInArrow(_fetched(_arrow(shape), length, unit), shape.schema), "run_bytes")

    small = fetched.where("content is not null").drop("strings")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = small.repartition(partitions, "hash").sortWithinPartitions("hash", "id", "digest", "at")
    shape = like(("low", "bigint"), ("high", "bigint"))
    sorted_ = small.mapInArrow(_matched(_arrow(shape), length, first, unit), shape.schema)

    pieces = fetched.where("content is null")
    alike = pieces.groupBy("hash", "more").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.first("strings").alias("strings"))
    alike = stage(alike, "equal_pieces")
    again = pieces.drop("strings").join(alike.where("first <> last").select("hash", "more", "first"), ["hash", "more"])
    if first:
        again = again.where(~position.eqNullSafe(F.col("first")))
    again = again.select("id", "digest", F.col("at").alias("low"), end.alias("high"))
    owner = F.xxhash64("id", "digest")
    dealt = alike.select("first.*", F.posexplode("strings").alias("nth", "string"))
    dealt = dealt.select("id", "digest", (F.col("at") + F.col("nth")).alias("at"), "string.*")
    strings = dealt.groupBy("hash", "more").agg(F.count("*").alias("n"), F.min(position).alias("first"), F.max(position).alias("last"))
    strings = stage(strings.where("first <> last").drop("last"), "equal_strings")
    often = strings.where(F.col("n") > GROUP).orderBy(F.col("n").desc(), "hash", "more").limit(FREQUENT)
    often = often.select("hash", "more", "first.*").select("hash", "more", owner.alias("owner"), "at").toArrow()
    keys, places = (zip(*(often[name].to_pylist() for name in names), strict=True) for names in (("hash", "more"), ("owner", "at")))
    frequent = spark.sparkContext.broadcast(dict(zip(keys, places, strict=True)))
    shape = like(("low", "bigint"), ("high", "bigint"), ("hash", "bigint"), ("more", "bigint"))
    looked = alike.select("first.*", "strings").withColumn("owner", owner).mapInArrow(_looked_up(_arrow(shape), length, first, frequent), shape.schema)
    looked = stage(looked, "looked_up")
    rest = looked.where("high is null").select("id", "digest", F.col("low").alias("at"), "hash", "more")
    met = rest.join(strings.select("hash", "more", "first"), ["hash", "more"])
    if first:
        met = met.where(~position.eqNullSafe(F.col("first")))
    met = met.select("id", "digest", F.col("at").alias("low"), (F.col("at") + length).alias("high"))
    met = met.union(looked.where("high is not null").select("id", "digest", "low", "high"))
    spans_ = stage(copies.union(sorted_).union(again).union(met), "repeated_spans")
    unstage(shared, equal, fetched, alike, strings, looked)
    return spans_


def _with_spans(docs: DataFrame, found: DataFrame, numbered: bool, id_col: str, text_col: str) -> tuple[DataFrame, str, Column]:
    """Docs with their spans, the spans' column, and whether a row is equal to an earlier one in id and text (if ``numbered``)."""
    found = found.groupBy("id", "digest").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"))
    of, of_digest, cuts = fresh(docs, "cut_id"), fresh(docs, "cut_digest"), fresh(docs, "cut_spans")
    found = found.select(F.col("id").alias(of), F.col("digest").alias(of_digest), F.col("spans").alias(cuts))
    digest, copy = fresh(docs, "text_digest"), fresh(docs, "copy")
    rows = docs.withColumn(digest, F.xxhash64(text_col))
    same = rows[id_col].eqNullSafe(F.col(of)) & (rows[digest] == F.col(of_digest))
    joined = rows.join(found.hint("shuffle_hash"), same, "left")
    if not numbered:
        return joined, cuts, F.lit(False)
    order = [F.xxhash64(rows[f"`{name}`"]) for name, kind in docs.dtypes if not kind.startswith("map")]
    joined = joined.withColumn(copy, F.row_number().over(Window.partitionBy(rows[id_col], rows[digest]).orderBy(*order)))
    return joined, cuts, F.col(copy) > 1


def cut(docs: DataFrame, length: int = 400, keep: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with the column ``cut``: kept bytes, n_bytes, n_removed, n_spans (maximal removed runs).

    With ``keep="first"``, all but one of the rows that are equal in id and text count as later copies.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    found = repeated_spans(docs, length, keep, id_col, text_col)
    joined, cuts, repeat = _with_spans(docs, found, keep == "first", id_col, text_col)

    shape = pa.struct([("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    @F.arrow_udf("struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>")
    def apply(texts: pa.Array, spans_: pa.Array, again: pa.Array) -> pa.Array:
        out = []
        for text, pieces, copied in zip(texts, spans_.to_pylist(), again.to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            pieces = [(p["low"], p["high"]) for p in pieces or ()]
            if copied and len(raw) >= length:
                pieces = [(0, len(raw))]
            kept, at, removed, count = [], 0, 0, 0
            for low, high in pieces:
                if high <= at and count:
                    continue
                if low > at or not count:
                    count += 1
                    kept.append(raw[at:low])
                    at = low
                removed += high - at
                at = high
            kept.append(raw[at:])
            out.append({"kept": b"".join(kept), "n_bytes": len(raw), "n_removed": removed, "n_spans": count})
        return pa.array(out, shape)

    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "cut"]
    return joined.select(*kept, apply(text_col, cuts, repeat).alias("cut"))


def passage_words(docs: DataFrame, words: int = 51, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words in passages of so many words that start anywhere else too: ``id``, ``digest`` (xxhash64) of the text, ``n_words``.

    Words are those of :func:`deduplicate_words`. Each text has one row, under each id it has, and none without such passages.
    """
    found = repeated_spans(docs, words, "none", id_col, text_col, WORDS)
    found = found.groupBy("id", "digest").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"))
    none = F.lit(0).cast("bigint")

    def add(done: Column, span: Column) -> Column:  # what of the span lies behind those before it
        more = F.greatest(span["high"] - F.greatest(span["low"], done["end"]), none)
        return F.struct((done["n"] + more).alias("n"), F.greatest(span["high"], done["end"]).alias("end"))

    n = F.aggregate("spans", F.struct(none.alias("n"), none.alias("end")), add, lambda done: done["n"])
    return found.select("id", "digest", n.alias("n_words"))


def deduplicate(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Docs with later copies cut out of the text. Bytes of a character that a cut has split go with it; null stays null."""
    done = cut(docs, length, "first", id_col, text_col)

    @F.arrow_udf("string")
    def whole_characters(kept: pa.Array) -> pa.Array:
        return pa.array([k.decode("utf-8", "ignore") for k in kept.to_pylist()], pa.string())

    changed = F.when(F.col("cut.n_removed") > 0, whole_characters("cut.kept")).otherwise(F.col(text_col))
    return done.withColumn(text_col, F.when(F.col(text_col).isNotNull(), changed)).drop("cut")


def deduplicate_words(docs: DataFrame, words: int = 51, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Docs with later copies of passages of so many words cut out, however many bytes these have; null stays null.

    Words are what stands between ASCII white space, and the corpus is searched as strings of word hashes, so copies may
    differ in white space. A cut runs from the first byte of its first word to the first byte of the next word that stays,
    or takes the white space before it at the end of a text. Rows that are equal in id and text are numbered; all but one lose
    all words if they have that many. Rows without id come first in the order of the corpus.
    """

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans_: pa.Array, again: pa.Array) -> pa.Array:
        out = []
        for text, pieces, copied in zip(texts, spans_.to_pylist(), again.to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            places = [m.span() for m in WORD.finditer(raw)] if pieces or copied else []
            gone = np.zeros(len(places), bool)
            gone[:] = copied and len(places) >= words
            for piece in pieces or ():
                gone[piece["low"] : piece["high"]] = True
            kept, at = [], 0
            for low, high in spans(gone):
                first = places[low][0]
                kept.append(raw[at:first] if high < len(places) else raw[at:first].rstrip(b" \t\n\v\f\r"))
                at = places[high][0] if high < len(places) else len(raw)
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pa.array(out, pa.string())

    joined, cuts, copied = _with_spans(docs, repeated_spans(docs, words, "first", id_col, text_col, WORDS), True, id_col, text_col)
    changed = F.col(text_col).isNotNull() & (F.col(cuts).isNotNull() | copied)
    left = F.when(changed, without(text_col, cuts, copied)).otherwise(F.col(text_col))
    return joined.select(*[left.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
