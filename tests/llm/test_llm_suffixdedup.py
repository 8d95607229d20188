import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from roamsight.llm import suffixdedup
from roamsight.llm.common import table
from roamsight.llm.queries import op7_suffix_array


def marked(texts, length, first):
    """For each text, which bytes go: by all strings of that length."""
    places = collections.defaultdict(list)
    for d, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places[text[i : i + length]].append((d, i))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found[1:] if first else found:
                gone[d][i : i + length] = b"\1" * length
    return gone


def expected(text, gone):
    kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
    spans = sum(1 for a, b in zip(b"\0" + bytes(gone), bytes(gone), strict=False) if b and not a)
    return (kept, len(text), sum(gone), spans)


def test_matches_of_every_start():
    random.seed(1)
    for _ in range(200):
        contents = [bytes(random.choice(b"ab\0") for _ in range(random.randint(4, 25))) for _ in range(3)]
        for first in (True, False):
            found = suffixdedup.match_starts(contents, 4, first)
            at = [(c, i) for c, text in enumerate(contents) for i in range(len(text) - 3)]
            same = lambda x, y: contents[x[0]][x[1] : x[1] + 4] == contents[y[0]][y[1] : y[1] + 4]
            for k, place in enumerate(at):
                others = at[:k] if first else at[:k] + at[k + 1 :]
                assert found[place[0]][place[1]] == any(same(place, o) for o in others)


def test_runs_cover_every_start_once_and_split_at_blocks(monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK", 1000)
    random.seed(2)
    for text in (bytes(random.choice(b"abcdef") for _ in range(5000)), b"a" * 3000, b"x" * 400, b"x" * 399):
        runs = list(suffixdedup.runs(text, 400))
        starts = [s for at, n, *_ in runs for s in range(at, at + n)]
        assert starts == list(range(len(text) - 399))
    assert all(twice for *_, twice in suffixdedup.runs(b"a" * 3000, 400))


def words(seed, n):
    source = random.Random(seed)
    return " ".join("".join(source.choice("abcdefghijklmnop") for _ in range(source.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared, line = words(1, 120), words(2, 80)
    found = [f"{words(10 + i, 150)} {shared} {words(50 + i, 150)}" for i in range(4)]
    found += [f"{words(100 + i, 3 + i % 7)} {line} {words(300 + i, 20)}" for i in range(90)]  # over GROUP surroundings
    found += [words(7, 300), words(7, 300), words(7, 300) + " end", "é" * 500, "z" * 1200, "ab" * 300, "short", "", words(8, 30)]
    near = words(9, 400).split()
    for place in (50, 200, 333):
        near[place] = "changed"
        found.append(" ".join(near))
    return found


@pytest.mark.parametrize("keep", ["none", "first"])
def test_against_brute_force(make_docs, texts, keep):
    rows = {r.doc_id: tuple(r.cut) for r in suffixdedup.cut(make_docs(list(enumerate(texts))), 400, keep).collect()}
    raw = [t.encode() for t in texts]
    for i, gone in enumerate(marked(raw, 400, keep == "first")):
        assert rows[i] == expected(raw[i], gone), i


def test_registered_query_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    raw = [(r.text or "").encode() for r in docs]
    rows = {r.doc_id: r for r in op7_suffix_array(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for r, text, gone in zip(docs, raw, marked(raw, 400, False), strict=True):
        kept, n, removed, spans = expected(text, gone)
        got = rows[r.doc_id]
        assert (got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_dirty_rows(make_docs, clashing):
    text = words(20, 200)
    docs = make_docs([(1, text), (1, text), (None, text), (4, None), (5, ""), (None, None)])
    docs = clashing(docs, "id", "digest", "cut", "spans", "low")
    none = {(r.doc_id, r.cut.n_removed, r.id) for r in suffixdedup.cut(docs, 400, "none").collect()}
    n = len(text)
    assert none == {(1, n, "extra id"), (None, n, "extra id"), (4, 0, "extra id"), (5, 0, "extra id"), (None, 0, "extra id")}
    first = sorted((r.doc_id or 0, r.text or "") for r in suffixdedup.deduplicate(docs, 400).collect())
    assert first == sorted([(0, text), (0, ""), (1, ""), (1, ""), (4, ""), (5, "")])  # ids without value come first
    assert suffixdedup.deduplicate(docs.limit(0), 400).collect() == []
    with pytest.raises(ValueError, match="keep"):
        suffixdedup.cut(docs, 400, "last")


def test_characters_stay_whole(make_docs):
    passage = words(30, 100)[:500]
    docs = make_docs([(1, f"é{passage}ß"), (2, f"©{passage}ß"), (3, f"è{passage}Ü")])
    left = {r.doc_id: r.text for r in suffixdedup.deduplicate(docs, 400).collect()}
    assert left == {1: f"é{passage}ß", 2: "", 3: "è"}  # © shares its last byte with é, Ü its first with ß


def test_removed_counts_are_those_of_the_whole_table(make_docs, texts):
    total = suffixdedup.cut(make_docs(list(enumerate(texts))), 400, "none").agg(F.sum("cut.n_removed")).first()[0]
    assert total == sum(map(sum, marked([t.encode() for t in texts], 400, False)))


def test_passages_in_words_go_but_for_the_first(make_docs):
    """51 words of under 400 bytes, which no length of 400 bytes sees; 50 words stay."""
    new = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    passage, short = new("é", 51), new("s", 50)
    assert len(passage.encode()) < 400
    rows = [
        (1, f"{new('a', 80)} {passage} {new('b', 9)}"),
        (2, f"{new('c', 9)}\n{passage.replace(' ', '  ', 3)} {new('d', 80)}"),
        (3, f"{new('e', 30)} {short} {new('f', 30)}"),
        (4, f"{new('g', 30)} {short} {new('h', 30)}"),
        (5, f"{new('i', 9)} {passage}"),
        (6, passage),
        (7, None),
    ]
    docs = make_docs(rows)
    assert {r.doc_id: r.text for r in suffixdedup.deduplicate(docs, 400).collect()} == dict(rows)
    found = suffixdedup.deduplicate_words(docs)
    assert found.columns == docs.columns
    expected = dict(rows) | {2: f"{new('c', 9)}\n{new('d', 80)}", 5: new("i", 9), 6: ""}
    assert {r.doc_id: r.text for r in found.collect()} == expected
    again = make_docs([(8, "x " * 400), (9, "y " * 60), (9, "y " * 60)])
    left = sorted((r.doc_id, r.text.split()) for r in suffixdedup.deduplicate_words(again).collect())
    # a text that repeats itself keeps its first word, as with bytes; of rows that are equal only one keeps it
    assert left == [(8, ["x"]), (9, []), (9, ["y"])]


def test_words_on_dirty_tables(make_docs, clashing):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(None, text), (1, text), (1, text), (2, None), (3, ""), (None, None)])
    docs = clashing(docs, "id", "digest", "low", "high", "cut_spans", "copy")
    found = suffixdedup.deduplicate_words(docs)
    assert found.columns == docs.columns
    left = sorted((r.doc_id or 0, r.text or "", r["copy"]) for r in found.collect())
    e = "extra copy"
    assert left == [(0, "", e), (0, text, e), (1, "", e), (1, "", e), (2, "", e), (3, "", e)]
    assert suffixdedup.deduplicate_words(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [8, 11])
def test_words_against_brute_force(make_docs, n):
    """Few different words, so that windows repeat inside texts and across them in every way."""
    rng = random.Random(n)
    rows = []
    for i in range(60):
        found = [f"é{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        if rows and i % 2:
            other = rows[rng.randrange(len(rows))][1].split()
            a = rng.randrange(max(1, len(other)))
            found[5:5] = other[a : a + rng.randrange(30)]
        rows.append((i, " ".join(found + found[: rng.choice([0, 0, 20])])))
    seen, expected = set(), {}
    for i, text in rows:
        found, gone = text.split(), [False] * len(text.split())
        for a in range(len(found) - n + 1):
            window = tuple(found[a : a + n])
            if window in seen:
                gone[a : a + n] = [True] * n
            seen.add(window)
        expected[i] = [w for w, g in zip(found, gone, strict=True) if not g]
    left = {r.doc_id: r.text.split() for r in suffixdedup.deduplicate_words(make_docs(rows), n).collect()}
    assert left == expected
    assert sum(map(len, left.values())) < sum(len(t.split()) for _, t in rows)


@pytest.mark.parametrize("frequent", [1 << 15, 40, 0])
@pytest.mark.parametrize("keep", ["first", "none"])
def test_a_passage_in_many_surroundings(make_docs, monkeypatch, keep, frequent):
    """Crowded buckets, whose runs are cut into pieces; all, some or none of the frequent strings are matched in the tasks."""
    monkeypatch.setattr(suffixdedup, "GROUP", 3)
    monkeypatch.setattr(suffixdedup, "FREQUENT", frequent)
    rng = random.Random(12)
    new = lambda n: " ".join(f"{rng.randrange(10**9)}" for _ in range(n))
    passage, other = new(70), new(30)
    texts = [f"{new(rng.randrange(20))} {passage} {new(rng.randrange(20))}" for _ in range(25)]
    texts += [f"{new(5)} {passage[200:]} {new(5)}" for _ in range(8)] + [f"{new(9)} {other} {passage[:480]} {new(9)}" for _ in range(8)]
    texts += [texts[0], texts[30]]
    docs = make_docs(list(enumerate(texts)))
    gone = marked([t.encode() for t in texts], 400, keep == "first")
    found = {r.doc_id: r.cut for r in suffixdedup.cut(docs, 400, keep).collect()}
    for i, text in enumerate(texts):
        assert found[i].n_removed == sum(gone[i])
        assert bytes(found[i].kept) == bytes(b for b, g in zip(text.encode(), gone[i], strict=True) if not g)


def test_words_are_split_as_they_are_placed():
    text = bytes(range(256)) + "a\u00a0b\u2003é \x1cq\x85".encode() + b"  x\t\ny\x0b\x0cz "
    coded = b"".join(suffixdedup.word_hashes(m.group()) for m in suffixdedup.WORD.finditer(text))
    assert suffixdedup.word_hashes(text) == coded and len(coded) == 8 * len(suffixdedup.WORD.findall(text))


def test_registered_query_counts_planted_passages_of_over_50_words(spark, tmp_path, make_docs):
    """Passages of 51 to 60 words and under 400 bytes, in two to five documents each: no byte goes, all their words count."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 6)))
    new = lambda n: [word() + str(rng.randrange(10**6)) for _ in range(n)]
    rows, planted = [], {}
    for k in range(10):
        passage = [word() for _ in range(51 + k)]
        assert len(" ".join(passage)) < 400
        for _ in range(2 + k % 4):
            rows.append((len(rows), " ".join(new(rng.randrange(40)) + passage + new(rng.randrange(40)))))
            planted[len(rows) - 1] = len(passage)
    half = [word() for _ in range(50)]
    rows += [(len(rows) + k, " ".join(new(20) + half + new(20))) for k in range(3)]  # 50 words stay uncounted
    rows += [(len(rows) + k, " ".join(new(30 + 9 * k))) for k in range(20)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (0, None), (None, None), (-1, "")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = op7_suffix_array(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_bytes) for r in found) == sorted((i or 0, len((t or "").encode())) for i, t in rows)
    whole = len(rows[0][1].split())  # as two rows hold this text as a whole
    for r in found:
        if r.doc_id is None or r.doc_id == 0:
            assert r.n_repeated_words == (whole if r.n_bytes else 0)
        else:
            assert (r.n_removed, r.n_repeated_words) == (0, planted.get(r.doc_id, 0))


@pytest.mark.parametrize("n", [8, 11])
def test_passage_words_against_brute_force(make_docs, n):
    rng = random.Random(n)
    texts = [[f"é{rng.randrange(30)}" for _ in range(rng.randrange(60))] for _ in range(40)]
    for text in texts[::2]:
        other = texts[rng.randrange(len(texts))]
        a = rng.randrange(max(1, len(other)))
        text[5:5] = other[a : a + rng.randrange(30)] + text[: rng.choice([0, 0, 12])]
    places = collections.Counter(tuple(t[a : a + n]) for t in texts for a in range(len(t) - n + 1))
    expected = {}
    for i, text in enumerate(texts):
        gone = [False] * len(text)
        for a in range(len(text) - n + 1):
            if places[tuple(text[a : a + n])] > 1:
                gone[a : a + n] = [True] * n
        expected |= {i: sum(gone)} if any(gone) else {}
    found = suffixdedup.passage_words(make_docs([(i, " ".join(t)) for i, t in enumerate(texts)]), n).collect()
    assert {r.id: r.n_words for r in found} == expected and len(found) == len(expected) > 5
