import hashlib
import random
import re

from roamsight.llm import decontaminate
from roamsight.llm.common import table
from roamsight.llm.queries import op6_suffix_automaton

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def naive(text, items, window):
    """Hit flags per word, and the ids of the items with occurring windows."""
    found, named = words(text), set()
    hit = [False] * len(found)
    for name, item in items:
        size = min(window, len(words(item)))
        for at in range(len(words(item)) - size + 1) if size else []:
            wanted = words(item)[at : at + size]
            for i in range(len(found) - size + 1):
                if found[i : i + size] == wanted:
                    hit[i : i + size] = [True] * size
                    named.add(name)
    return hit, named


def test_automaton_against_brute_force():
    random.seed(5)
    for _ in range(300):
        items = [(str(i), " ".join(random.choices("abc", k=random.randint(0, 7)))) for i in range(random.randint(0, 5))]
        window = random.choice([1, 2, 3, 4])
        text = " ".join(random.choices("abcd", k=20))
        machine = decontaminate.Automaton([(i, words(t), False) for i, t in items], window)
        n, spans, named = machine.scan([words(text)[:9], words(text)[9:]])
        hit, expected = naive(text, items, window)
        flags = [any(a <= i < b for a, b in spans) for i in range(n)]
        assert (flags, named) == (hit, expected)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_words_of_a_long_text_are_not_cut(monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    text = "abc déf ghijklmnopqrstu x" * 30
    assert [w for part in decontaminate.words(text.encode()) for w in part] == words(text)


def test_blocks_of_items_give_the_same(spark, make_docs, monkeypatch):
    random.seed(8)
    texts = [" ".join(random.choices("abcdefg", k=60)) for _ in range(30)]
    items = [(i, " ".join(random.choices("abcdefg", k=random.choice([0, 2, 3, 9, 40])))) for i in range(12)]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    docs = make_docs(list(enumerate(texts)))
    whole = {r.doc_id: (r.n_hit, r.hit_spans, r.items) for r in decontaminate.contamination(docs, frame, 3).collect()}
    for i, text in enumerate(texts):
        hit, named = naive(text, items, 3)
        assert whole[i][0] == sum(hit) and whole[i][2] == sorted(map(str, named))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)  # several automata, and items cut into pieces
    assert len(list(decontaminate.automata(frame, 3))) > 3
    assert {r.doc_id: (r.n_hit, r.hit_spans, r.items) for r in decontaminate.contamination(docs, frame, 3).collect()} == whole


def test_registered_query_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    items = [(str(r.item_id), r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    rows = {r.doc_id: r for r in op6_suffix_automaton(spark, sf_dir).collect()}
    windows = {}
    for name, text in items:
        found = words(text)
        for at in range(max(1, len(found) - 9) if found else 0):
            windows.setdefault(tuple(found[at : at + 10]), set()).add(name)
    for r in docs:
        found = words(r.text)
        hit, named = [False] * len(found), set()
        for size in {len(w) for w in windows}:
            for at in range(len(found) - size + 1):
                if tuple(found[at : at + size]) in windows:
                    hit[at : at + size] = [True] * size
                    named |= windows[tuple(found[at : at + size])]
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        expected = (len(found), sum(hit), len(named), digest, any(hit))
        got = rows[r.doc_id]
        assert (got.n_words, got.n_hit, got.n_items, got.items_sha256, got.contaminated) == expected
    assert any(r.contaminated for r in rows.values())


def test_dirty_rows(spark, make_docs, clashing):
    items = spark.createDataFrame([(1, "A b C"), (1, "a b c"), (None, "x y"), (3, None), (4, ""), (5, "...")], "item_id int, text string")
    docs = make_docs([(1, "q A, b; c! r"), (1, "q A, b; c! r"), (2, "x y"), (3, None), (4, ""), (None, "x-y z z z z z z z z z")])
    docs = clashing(docs, "items", "scan", "n_words", "cut_text")
    rows = decontaminate.contamination(docs, items, 10).collect()
    found = sorted((r.doc_id or 0, r.n_words, r.n_hit, r["items"], r.scan) for r in rows)
    none, extra = [], "extra scan"
    assert found == [(0, 11, 2, none, extra), (1, 5, 3, ["1"], extra), (1, 5, 3, ["1"], extra), (2, 2, 2, none, extra), (3, 0, 0, none, extra), (4, 0, 0, none, extra)]
    left = decontaminate.remove(docs, items, 10)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id or 0, r.text or "", r.cut_text) for r in left.collect())
    extra = "extra cut_text"
    assert kept == [(0, " z z z z z z z z z", extra), (1, "q ! r", extra), (1, "q ! r", extra), (3, "", extra), (4, "", extra)]
    assert decontaminate.remove(docs.limit(0), items).collect() == []
    assert decontaminate.remove(docs, items.limit(0)).count() == 6


def test_words_of_a_long_text_in_capitals(spark, make_docs):
    text = "ABCDEFG HIJK " * 200_000  # over 2 MiB, and both slices end within a word
    assert [w for part in decontaminate.words(text.encode()) for w in part] == words(text)
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = decontaminate.remove(make_docs([(1, f"{text}before {item.upper()} after")]), items).first()
    assert kept.text == f"{text}before  after"
