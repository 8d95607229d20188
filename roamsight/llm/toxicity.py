"""Toxicity by class-conditional Kneser-Ney models.

Two language models, of toxic and of ordinary labelled documents, spell every word letter by letter, each letter given
the ``ORDER - 1`` before it. A class's own counts are discounted; what the discount frees goes to the next shorter
context, and from there on both classes share one Kneser-Ney model whose counts are continuation counts (in how many
different longer contexts a sequence occurs in either class). A word or spelling that a class has rarely or never seen
is thus smoothed by what both classes know.

A document's evidence is its toxic minus its ordinary log-likelihood, divided by its number of words, and the same over
what single words contribute beyond ``STRONG``, where the models differ by more than the noise of smoothing. The rate at
which given evidence means toxic is a logistic curve, fitted on labelled documents that the counts have not seen: counts come
from rows whose crc32(id) mod 4 is 0 or 1, the curve from at most ``CURVE_ROWS`` rows of remainder 3 (chosen by a hash of
the id), and remainder 2 is held out from everything. Labels, language, source and id are never inputs of a score.

Counting is a grouped sum per word, then per letter sequence, both combined before the shuffle. Every counted sequence and
context stays in the model, which is two stored tables that grow with the labelled corpus. Only the ``FREQUENT`` sequences
that labelled texts hold most often go to the workers, as sorted arrays. A pass over the documents adds up what words
spelled by these alone contribute and passes the other words on; the different ones among them are spelled, joined with
the tables, and their scores joined back. Scores of letters are whole numbers of 1 / ``UNIT``, so sums do not depend on their
order and the scores of documents not on which sequences are frequent. Words are cut into parts of ``LONGEST`` letters.

Null and empty texts have no words and evidence zero. Rows without an id are scored like any other; their remainder is
that of an empty string. Without labelled rows of both classes every score is the share of toxic ones among the labels.
Evidence finds its row by two 64-bit hashes of all simple columns, so copies of a text under different ids spread over
tasks; docs must give the same rows when they are read again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from roamsight.llm.common import fresh, kept_by, with_results
from roamsight.operators.membership import filter_words, key_filter, perhaps_in
from roamsight.operators.skew import hot_keys, join_sliced
from roamsight.params import Params, Skew
from roamsight.sources.staging import measured, stage, unstage

ORDER = 5
DISCOUNT = 0.75
#: Sequences whose scores are sent to every worker, 16 bytes each.
FREQUENT = 2**19
#: Evidence of at most so many rows (of two hashes and three numbers) is sent to the documents, scores of at most so many rare words to
#: their places; more is joined by shuffle. The documents' words are never sent: Spark sizes their explode as one row a document.
BROADCAST_ROWS = 20_000
UNIT = 2**16
CURVE_ROWS = 20_000
REJECTED = 0.3
#: Log ratios of a word beyond this are no smoothing noise.
STRONG = 6.0
EVIDENCE = ("mean", "strong", "count")
CACHED = 300_000
SPELLED = 20_000
LONGEST = 40
WORD = re.compile(rf"\w{{1,{LONGEST}}}")
_START, _END = 0, 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def sequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the last 0 to ORDER letters at each place of the padded words, and the number of the word it predicts for.

    Row k of the first array holds sequences of k letters. Places that belong to the padding before a word have number -1.
    """
    pad = chr(_START) * (ORDER - 1)
    letters = np.frombuffer("".join(f"{pad}{w}{chr(_END)}" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + ORDER for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(starts, sizes)
    owner = np.where(place < ORDER - 1, -1, owner)
    rows = [np.full(len(letters), 7, np.uint64)]
    mixed = letters + np.uint64(1)
    for k in range(1, ORDER + 1):
        before = np.concatenate([rows[0][:1], rows[-1][:-1]])
        x = (before ^ (mixed * _FACTOR)) + np.uint64(k)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xD6E8FEB86659FD93)
        rows.append(x ^ (x >> np.uint64(32)))
    return np.stack(rows).view(np.int64), owner


_WORDS = "word string, toxic bigint, ordinary bigint"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts in toxic and ordinary texts, added up within the task as far as memory allows."""
    counts: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def flush() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        toxic, ordinary = ([c.get(w, 0) for w in words] for c in counts[::-1])
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(words, pa.string()), "toxic": pa.array(toxic, pa.int64()), "ordinary": pa.array(ordinary, pa.int64())}
        )

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            mine = counts[toxic]
            for match in WORD.finditer((text.as_py() or "").lower()):
                word = match.group()
                mine[word] = mine.get(word, 0) + 1
            if len(counts[0]) + len(counts[1]) > CACHED:
                yield flush()
    yield flush()


_GRAMS = ", ".join([f"g{k} bigint" for k in range(1, ORDER + 1)] + [f"c{k} bigint" for k in range(2, ORDER + 1)])


def _count_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter sequences of the words: g1 .. gORDER end at the same letter, ck is the context of gk."""
    for batch in batches:
        for low in range(0, batch.num_rows, 1000):
            part = batch.slice(low, 1000)
            rows, owner = sequences(part["word"].to_pylist())
            at = np.flatnonzero(owner >= 0)
            keys, first, inverse = np.unique(rows[ORDER, at], return_index=True, return_inverse=True)
            columns = {f"g{k}": rows[k, at[first]] for k in range(1, ORDER + 1)}
            columns |= {f"c{k}": rows[k - 1, at[first] - 1] for k in range(2, ORDER + 1)}
            for name in ("toxic", "ordinary"):
                weights = part[name].to_numpy()[owner[at]]
                columns[name] = np.bincount(inverse, weights, len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({name: pa.array(column) for name, column in columns.items()})


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, mod 4."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def count_words(labelled: DataFrame) -> DataFrame:
    """Counts per word of rows (text, toxic boolean)."""
    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(_count_words, _WORDS)
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _discounted(count: str, total: str, types: str, lower: Column | str) -> Column:
    """Interpolated absolute discounting; a context never seen leaves everything to the lower order."""
    lower = F.col(lower) if isinstance(lower, str) else lower
    own = F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(types) * lower
    return F.when(F.col(total) > 0, own / F.col(total)).otherwise(lower)


def sequence_scores(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, score) of letter sequences, with their number n, and of contexts: the log ratio of the two class models.

    The score of a context is that of a letter which neither class has seen after it.
    """
    counted = words.mapInArrow(_count_sequences, f"{_GRAMS}, toxic bigint, ordinary bigint")
    rest = [f"g{k}" for k in range(1, ORDER)] + [f"c{k}" for k in range(2, ORDER + 1)]
    top = counted.groupBy(f"g{ORDER}").agg(
        *[F.first(name).alias(name) for name in rest], F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )
    top = stage(top, "sequences")
    # continuation counts: how many different longer sequences end in this one
    levels = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        names = [f"g{j}" for j in range(1, k)] + [f"c{j}" for j in range(2, k + 1)]
        kept = [F.first(name).alias(name) for name in names]
        levels[k] = levels[k + 1].groupBy(f"g{k}").agg(*kept, F.count("*").alias("n"))
    letters = levels[1].agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    shared = levels[1].crossJoin(F.broadcast(letters))  # one row
    shared = shared.select("g1", _discounted("n", "total", "types", 1 / (F.col("types") + 1)).alias("p"))
    for k in range(2, ORDER):
        contexts = levels[k].groupBy(f"c{k}").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        joined = levels[k].join(contexts, f"c{k}").join(shared, f"g{k - 1}")
        shared = joined.select(f"g{k}", _discounted("n", "total", "types", "p").alias("p"))
    context = f"c{ORDER}"
    sums = [F.sum(name).alias(f"{name}_total") for name in ("toxic", "ordinary")]
    types = [F.count_if(F.col(name) > 0).alias(f"{name}_types") for name in ("toxic", "ordinary")]
    contexts = top.groupBy(context).agg(*sums, *types)
    grams = top.join(contexts, context).join(shared, f"g{ORDER - 1}")
    ratio = F.log(_discounted("toxic", "toxic_total", "toxic_types", "p")) - F.log(
        _discounted("ordinary", "ordinary_total", "ordinary_types", "p")
    )
    left = [
        F.when(F.col(f"{c}_total") > 0, DISCOUNT * F.col(f"{c}_types") / F.col(f"{c}_total")).otherwise(F.lit(1.0))
        for c in ("toxic", "ordinary")
    ]
    return (
        grams.select(F.col(f"g{ORDER}").alias("key"), ratio.alias("score"), (F.col("toxic") + F.col("ordinary")).alias("n")),
        contexts.select(F.col(context).alias("key"), (F.log(left[0]) - F.log(left[1])).alias("score")),
    )


@dataclass
class Model:
    """Stored scores of letter sequences and contexts, those of the most frequent by ascending key, the curve over the evidence."""

    grams: DataFrame
    contexts: DataFrame
    keys: np.ndarray
    units: np.ndarray
    curve: np.ndarray | None = None
    share: float = 0.0  # of toxic labels

    @property
    def gram_keys(self) -> np.ndarray:
        """Hashes of all sequences, ascending; for looking into small models, scoring never gathers them."""
        return self.grams.orderBy("key").toArrow()["key"].to_numpy()

    @property
    def gram_scores(self) -> np.ndarray:
        """Scores in the order of :attr:`gram_keys`."""
        return self.grams.orderBy("key").toArrow()["score"].to_numpy()


def known_words(words: list[str], keys: np.ndarray, units: np.ndarray) -> list[int | None]:
    """Units of each word, or None if one of its sequences is not among the keys."""
    rows, owner = sequences(words)
    at = np.flatnonzero(owner >= 0)
    wanted = rows[ORDER, at]
    place = np.searchsorted(keys, wanted)
    found = np.zeros(len(at), bool)
    within = place < len(keys)
    found[within] = keys[place[within]] == wanted[within]
    sums = np.zeros(len(words), np.int64)
    np.add.at(sums, owner[at[found]], units[place[found]])
    lacking = np.bincount(owner[at[~found]], minlength=len(words))
    return [None if lack else total for total, lack in zip(sums.tolist(), lacking.tolist(), strict=True)]


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter sequences of the words with their contexts and the words that hold them, one row per sequence and SPELLED words.

    A sequence that very many words share thus moves in few rows. A word that holds it twice is listed twice.
    """

    def spelled(words: list[str]) -> pa.RecordBatch:
        rows, owner = sequences(words)
        at = np.flatnonzero(owner >= 0)
        at = at[np.argsort(rows[ORDER, at], kind="stable")]
        keys, first = np.unique(rows[ORDER, at], return_index=True)
        offsets = pa.array(np.append(first, len(at)), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(words, pa.string()).take(pa.array(owner[at])))
        return pa.RecordBatch.from_pydict({"g": pa.array(keys), "c": pa.array(rows[ORDER - 1, at[first] - 1]), "words": lists})

    held: list[str] = []
    for batch in batches:
        held += batch["word"].to_pylist()
        if len(held) >= SPELLED:
            yield spelled(held)
            held = []
    if held:
        yield spelled(held)


def _units(score: str) -> Column:
    return F.round(F.col(score) * UNIT).cast("bigint")


def word_scores(words: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(word, units) of different words: toxic minus ordinary log-likelihood in units of 1 / UNIT."""
    spelled = words.select("word").mapInArrow(_spell, "g bigint, c bigint, words array<string>")
    own = grams.select(F.col("key").alias("g"), F.col("score").alias("own"))
    unseen = contexts.select(F.col("key").alias("c"), F.col("score").alias("unseen"))
    found = spelled.join(own, "g", "left").join(unseen, "c", "left")
    units = F.coalesce(_units("own"), _units("unseen"), F.lit(0).cast("bigint"))
    found = found.select(units.alias("units"), F.explode("words").alias("word"))
    return found.groupBy("word").agg(F.sum("units").alias("units"))


def inputs(evidence: np.ndarray) -> np.ndarray:
    """What the curve sees: both means, the strong one also as a sum over the text, and the length; sums as logarithms."""
    mean, strong, count = evidence.T
    return np.stack([np.ones(len(mean)), mean, strong, np.log1p(strong * count), np.log1p(count)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge keeps separable classes finite."""
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    scale[0] = 1.0
    z, b = x / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge * np.eye(len(b)), z.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b / scale


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows whose remainder is not 2. Several labels of one id count as toxic if one is; null labels as none."""
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).try_cast(docs.schema[id_col].dataType).alias("id"))
    marks = marks.agg(F.max(F.col(label_col) > 0).alias("toxic"))
    marks, size = measured(marks.withColumn("part", remainder("id")).where("part <> 2"), "marks", rows=F.count(F.lit(1)))
    hashes = marks.where("part = 3").select(F.xxhash64("id").alias("hash"))
    last = hashes.orderBy("hash").limit(CURVE_ROWS).agg(F.max("hash")).first()[0]
    used = marks.where((F.col("part") < 2) | (F.xxhash64("id") <= F.lit(last).cast("bigint")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(remainder("id") != 2)
    # texts without a label that is used, or nearly all of them, stay where they are
    words = filter_words(size["rows"], Params().filter_words)
    texts = perhaps_in(texts, "id", key_filter(used, "id", words), words)
    labelled = stage(texts.join(used.hint("shuffle_hash"), "id").select("text", "toxic", "part"), "labelled")
    words = stage(count_words(labelled.where("part < 2")), "class_words")
    grams, contexts = (stage(found, "letter_scores") for found in sequence_scores(words))
    often = grams.orderBy(F.col("n").desc(), "key").limit(FREQUENT).select("key", _units("score").alias("units")).toArrow()
    keys, units = (often[name].to_numpy() for name in ("key", "units"))
    order = np.argsort(keys)
    model = Model(grams, contexts, keys[order], units[order])
    seen = with_evidence(labelled.where("part = 3").select("toxic", "text"), model).select("toxic", *EVIDENCE).toArrow()
    unstage(words, labelled, marks)
    y = seen["toxic"].to_numpy().astype(np.float64) if len(seen) else np.zeros(0)
    model.share = float(y.mean()) if len(y) else 0.0
    if 0 < model.share < 1:
        model.curve = fit_curve(inputs(np.stack([seen[name].to_numpy() for name in EVIDENCE], axis=1)), y)
    return model


_PARTS = "a bigint, b bigint, ratio bigint, strong bigint, number bigint, words array<string>, times array<bigint>"


def _counted(text: str | None) -> dict[str, int]:
    counts: dict[str, int] = {}
    for match in WORD.finditer((text or "").lower()):
        word = match.group()
        counts[word] = counts.get(word, 0) + 1
    return counts


def _weighed(part: pa.RecordBatch, counted: list[dict[str, int]], known: dict[str, int | None], strong_from: int) -> pa.RecordBatch:
    """Sums over the known words of each text, and its other words."""
    ratios, strongs, numbers, words, times = [], [], [], [], []
    for counts in counted:
        ratio = strong = 0
        rest = []
        for word, n in counts.items():
            units = known[word]
            if units is None:
                rest.append(word)
                continue
            ratio += units * n
            if units > strong_from:
                strong += (units - strong_from) * n
        ratios.append(ratio)
        strongs.append(strong)
        numbers.append(sum(counts.values()))
        words.append(rest)
        times.append([counts[word] for word in rest])
    columns = [pa.array(column, pa.int64()) for column in (ratios, strongs, numbers)]
    lists = [pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
    names = ["a", "b", "ratio", "strong", "number", "words", "times"]
    return pa.RecordBatch.from_arrays([part["a"], part["b"], *columns, *lists], names=names)


def _evidence(docs: DataFrame, model: Model) -> tuple[DataFrame, int]:
    """(a, b, mean, strong, count) per key of rows (a, b, text), and an upper bound of their number.

    ``mean`` is the mean log ratio of a word, ``strong`` the mean of what exceeds STRONG. Rows that are equal share a key:
    their sums and numbers of words are multiples, which leaves the means as they are.
    """
    shared, owner = docs.sparkSession.sparkContext.broadcast((model.keys, model.units)), ("toxicity", uuid4().hex)
    strong_from = round(STRONG * UNIT)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int | None] = kept_by(owner, dict)
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                counted = [_counted(text.as_py()) for text in part["text"]]
                if len(known) > CACHED:
                    known.clear()
                new = list({word for counts in counted for word in counts if word not in known})
                for first in range(0, len(new), SPELLED):
                    some = new[first : first + SPELLED]
                    known.update(zip(some, known_words(some, *shared.value), strict=True))
                yield _weighed(part, counted, known, strong_from)

    parts, size = measured(docs.mapInArrow(weigh, _PARTS), "evidence_parts", rows=F.count(F.lit(1)))
    rare = parts.select("a", "b", F.explode(F.arrays_zip("words", "times")).alias("found"))
    rare = rare.select("a", "b", F.col("found.words").alias("word"), F.col("found.times").alias("times"))
    words, different = measured(rare.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "rare_words", rows=F.count(F.lit(1)))
    scores = stage(word_scores(words, model.grams, model.contexts), "word_scores")
    scores = scores.hint("broadcast" if different["rows"] <= BROADCAST_ROWS else "merge")
    met = join_sliced(rare, scores, "word", "a", hot_keys(words, "word", "n", Skew()), "inner")
    met = met.select(
        "a", "b", (F.col("units") * F.col("times")).alias("ratio"),
        (F.greatest(F.col("units") - strong_from, F.lit(0)) * F.col("times")).alias("strong"),
        F.lit(0).cast("bigint").alias("number"), F.lit(0).cast("bigint").alias("copies"),
    )
    sums = parts.select("a", "b", "ratio", "strong", "number", F.lit(1).cast("bigint").alias("copies")).unionByName(met)
    sums = sums.groupBy("a", "b").agg(*[F.sum(name).alias(name) for name in ("ratio", "strong", "number", "copies")])
    mean = lambda name: F.when(F.col("number") > 0, F.col(name) / F.col("number") / UNIT).otherwise(0.0)
    count = (F.col("number") / F.col("copies")).alias("count")
    found = sums.select("a", "b", mean("ratio").alias("mean"), mean("strong").alias("strong"), count)
    found = stage(found, "evidence")
    unstage(parts, words, scores)
    return found, size["rows"]


def with_evidence(docs: DataFrame, model: Model, text_col: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """Docs with the columns of EVIDENCE, under other names if ``names`` gives some; docs must not have columns so named."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    simple = [f.name for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name.lower() != text_col.lower()]
    keys = [F.xxhash64(F.lit(number), text, *[F.col(f"`{name}`") for name in simple]) for number in (1, 2)]
    found, rows = _evidence(docs.select(keys[0].alias("a"), keys[1].alias("b"), text.alias("text")), model)
    mine = [fresh(docs, f"evidence_key_{name}") for name in "ab"]
    found = found.withColumnsRenamed(dict(zip("ab", mine, strict=True)) | (names or {}))
    hint = "broadcast" if rows <= BROADCAST_ROWS else "shuffle_hash"
    keyed = docs.withColumns(dict(zip(mine, keys, strict=True)))
    return keyed.join(found.hint(hint), mine, "left").drop(*mine)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Docs with ``score``, the estimated probability of the toxic label."""
    if model.curve is None:
        return with_results(docs, {"score": F.lit(model.share)})
    names = {name: fresh(docs, f"evidence_of_{name}") for name in EVIDENCE}
    found = with_evidence(docs, model, text_col, names)
    mean, strong, count = (F.col(name) for name in names.values())
    seen = [F.lit(1.0), mean, strong, F.log1p(strong * count), F.log1p(count)]
    z = reduce(lambda x, y: x + y, [float(weight) * x for weight, x in zip(model.curve, seen, strict=True)])
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
    return with_results(found, {"score": score}).drop(*names.values())
