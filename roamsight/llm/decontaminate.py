"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of all test items form one automaton, built once on the driver: its states stand for classes of word
sequences that end at the same places. A document's words then stream through it; after each word the state gives the
longest sequence, ending there, that occurs in any item. Where that length reaches a window (``window`` words, or a whole
item that is shorter), the words of the window are hit, and the state on the suffix path whose class contains exactly
that window names the items it came from. No document is compared with items one by one.

The automaton is broadcast, so its size is checked: items are taken in blocks of at most ``BLOCK_WORDS`` words (a longer
item in pieces that overlap by a window less one), and every further block is another pass with its own automaton.
Benchmarks of ordinary size are one block.

Words are runs of ASCII digits, ASCII letters (lower-cased) and all other non-ASCII characters. Null and empty texts have
no words; items without words have no windows. Items with a null id count for hits but not in the list of items; rows
with one item id are one item as far as the list is concerned.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, with_results

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_WORDS = 100_000
SLICE = 1 << 20


def words(text: bytes) -> Iterator[list[bytes]]:
    """Words of one UTF-8 text in lists of moderate size, so that memory does not grow with the text."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and WORD.match(text[end - 1 : end].lower()):  # do not cut a word
            end += 1
        yield WORD.findall(text[at:end].lower())
        at = end


class Automaton:
    """Generalised suffix automaton over word ids, with the windows that each state's class contains."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes], bool]], window: int):
        """``items``: id, words, and whether the words are a piece of a longer item."""
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[dict[int, set[str]]] = [{}]  # window length -> items, at the state whose class has that window
        kept = [(name, [self.ids.setdefault(w, len(self.ids)) for w in ws], piece) for name, ws, piece in items if ws]
        for _, numbers, _ in kept:
            last = 0
            for number in numbers:
                last = self._extend(last, number)
        for name, numbers, piece in kept:
            if len(numbers) >= window or not piece:
                self._name(name, numbers)
        self.shortest = min((n for found in self.items for n in found), default=0)
        # the nearest state on the suffix path, itself included, that holds a window
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.nearest = [-1] * len(self.link)
        for state in order:
            self.nearest[state] = state if self.items[state] else self.nearest[self.link[state]]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.items.append({})
        return len(self.link) - 1

    def _extend(self, last: int, number: int) -> int:
        """Append a word to the sequence that ends in ``last``; the state of the extended sequence."""
        known = self.next[last].get(number)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, number, known)
        made = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and number not in self.next[at]:
            self.next[at][number] = made
            at = self.link[at]
        if at >= 0:
            known = self.next[at][number]
            self.link[made] = known if self.length[known] == self.length[at] + 1 else self._split(at, number, known)
        return made

    def _split(self, at: int, number: int, known: int) -> int:
        """Take the shorter sequences of a class, up to those that continue ``at``, into a class of their own."""
        copy = self._state(self.length[at] + 1, self.link[known], dict(self.next[known]))
        self.link[known] = copy
        while at >= 0 and self.next[at].get(number) == known:
            self.next[at][number] = copy
            at = self.link[at]
        return copy

    def _name(self, name: str | None, numbers: list[int]) -> None:
        """Note the item at the state of each of its windows."""
        size = min(self.window, len(numbers))
        state = length = 0
        for number in numbers:
            state, length = self.step(state, length, number)
            while self.length[self.link[state]] >= size:
                state = self.link[state]
            length = min(length, size)
            if length == size:
                found = self.items[state].setdefault(size, set())
                if name is not None:
                    found.add(name)

    def step(self, state: int, length: int, number: int | None) -> tuple[int, int]:
        """The longest match after one more word."""
        while state and number not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(number)
        return (0, 0) if following is None else (following, length + 1)

    def scan(self, lists: Iterable[list[bytes]]) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, maximal hit spans [first, end), and ids of the items with occurring windows."""
        ids, following, link, lengths = self.ids, self.next, self.link, self.length
        nearest, shortest = self.nearest, self.shortest
        state = length = 0
        end = 0
        spans: list[list[int]] = []
        named: set[str] = set()
        for part in lists:
            start = end
            for end, number in enumerate(map(ids.get, part), start + 1):
                if number is None:
                    state = length = 0
                    continue
                while state and number not in following[state]:
                    state = link[state]
                    length = lengths[state]
                to = following[state].get(number)
                if to is None:
                    state = length = 0
                    continue
                state = to
                length += 1
                if length < shortest or nearest[state] < 0:
                    continue
                holder, most = nearest[state], 0
                while holder > 0:
                    for size, items in self.items[holder].items():
                        if size <= length:
                            most = max(most, size)
                            named |= items
                    holder = nearest[link[holder]]
                if most:
                    low = end - most
                    while spans and spans[-1][1] >= low:
                        low = min(low, spans.pop()[0])
                    spans.append([low, end])
            end = start + len(part)
        return end, spans, named


def _pieces(text: bytes, window: int) -> Iterator[tuple[list[bytes], bool]]:
    """An item's words, or overlapping pieces of at most half a block that keep every window whole."""
    size = BLOCK_WORDS // 2
    carried: list[bytes] = []
    cut = False
    for part in words(text):
        carried += part
        while len(carried) > size:
            yield carried[:size], True
            cut = True
            carried = carried[size - window + 1 :]
    yield carried, cut


def automata(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[Automaton]:
    """One automaton per block of items; the driver holds one block at a time."""
    block: list[tuple[str | None, list[bytes], bool]] = []
    total = 0
    for row in items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        for found, cut in _pieces((row.text or "").encode(), window):
            if block and total + len(found) > BLOCK_WORDS:
                yield Automaton(block, window)
                block, total = [], 0
            block.append((row.id, found, cut))
            total += len(found)
    yield Automaton(block, window)


_FOUND = "struct<n_words:bigint,spans:array<array<bigint>>,items:array<string>>"


def scanned(spark: SparkSession, text: Column, automaton: Automaton) -> Column:
    """Number of words, hit spans and items of each text."""
    shared = spark.sparkContext.broadcast(automaton)
    shape = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        machine = shared.value
        out = []
        for text in texts:
            n, spans, items = machine.scan(words(text.as_buffer().to_pybytes())) if text.is_valid else (0, [], set())
            out.append({"n_words": n, "spans": spans, "items": sorted(items)})
        return pa.array(out, shape)

    return scan(text)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Docs with ``n_words``, ``n_hit``, ``hit_spans`` (word numbers [first, end)), ``items`` (sorted ids as strings)."""
    spark = docs.sparkSession
    found = [scanned(spark, F.col(text_col), a) for a in automata(items, window, item_id, item_text)]
    name = fresh(docs, "scan")
    marked = docs.withColumns({f"{name}{i}": column for i, column in enumerate(found)})
    parts = [f"{name}{i}" for i in range(len(found))]
    spans, named = F.col(f"{parts[0]}.spans"), F.col(f"{parts[0]}.items")
    if len(parts) > 1:  # spans and items of several blocks

        @F.udf("array<array<bigint>>")
        def union(spans):
            return _merged([list(s) for s in spans])

        spans = union(F.flatten(F.array(*[F.col(f"{p}.spans") for p in parts])))
        named = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.items") for p in parts]))))
    hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, span: n + span[1] - span[0])
    results = {"n_words": F.col(f"{parts[0]}.n_words"), "hit_spans": spans, "items": named}
    out = with_results(marked, results).drop(*parts)
    return with_results(out, {"n_hit": hit})


def remove(
    docs: DataFrame, items: DataFrame, window: int = 10, coverage: float = 0.8, text_col: str = "text", **names: str
) -> DataFrame:
    """Docs without benchmark passages: hit words are cut out of the text with what stands between them.

    A document whose hit words make up ``coverage`` or more of all its words is dropped. Texts without hits stay as they
    are. What is left on both sides of a cut keeps its punctuation and white space.
    """
    found = contamination(docs, items, window, text_col, **names)

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, pieces in zip(texts, spans.to_pylist(), strict=True):
            out.append(_without(text.as_py().encode(), pieces).decode() if pieces else text.as_py())
        return pa.array(out, pa.string())

    kept = found.where(~((F.col("n_hit") > 0) & (F.col("n_hit") >= F.lit(coverage) * F.col("n_words"))))
    left = F.when(F.col("n_hit") > 0, without(text_col, "hit_spans")).otherwise(F.col(text_col))
    return kept.select(*[left.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def _without(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans; cuts run from the first byte of a span's first word to the last word's end."""
    out, kept, number = [], 0, 0
    pieces = iter(spans)
    low, high = next(pieces)
    for match in WORD.finditer(text.lower()):  # as long as the text
        if number == low:
            out.append(text[kept : match.start()])
        number += 1
        if number == high:
            kept = match.end()
            low, high = next(pieces, (-1, -1))
    return b"".join([*out, text[kept:]])
