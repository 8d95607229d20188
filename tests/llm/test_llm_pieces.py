import hashlib
import random
import struct

import pytest

from roamsight.llm import pieces
from roamsight.llm.common import table
from roamsight.llm.queries import op5_sentencepiece

ODD = ["", " ", "\n", "  two  blanks ", "\n\nx\t\r\n", "x▁y ▁", "▁", "ÿ\x00日本\U0001f600 é", "the quick brown fox", "a" * 5000, "<s></s><unk><0x0A>"]


@pytest.fixture(scope="module")
def known():
    return pieces.vocabulary()


def best_score(known, text):
    """By trying every piece at every end."""
    marked = pieces.BLANK + text.replace(" ", pieces.BLANK)
    longest = max(map(len, known.pieces))
    best = [0.0]
    for end in range(1, len(marked) + 1):
        options = [best[end - 1] + pieces.BYTE_SCORE * len(marked[end - 1].encode())]
        for start in range(max(0, end - longest), end):
            if marked[start:end] in known.pieces:
                options.append(best[start] + known.pieces[marked[start:end]][1])
        best.append(max(options))
    return best[-1]


def score(known, ids):
    scores = {number: value for number, value in known.pieces.values()}
    return sum(scores.get(i, pieces.BYTE_SCORE) for i in ids.tolist())


def test_best_segmentation(known):
    random.seed(3)
    for _ in range(200):
        text = "".join(random.choices("the andingofé \nñü日,.;'%1", k=25))
        ids = known.encode(text, pieces.Cache())
        assert known.decode(ids) == text
        assert score(known, ids) == pytest.approx(best_score(known, text))
        assert ids.tolist() == known.best(pieces.BLANK + text.replace(" ", pieces.BLANK))  # cutting changes nothing


def test_odd_texts(known):
    for text in ODD:
        assert known.decode(known.encode(text, pieces.Cache())) == text


def test_vocabularies_that_cannot_be_cut():
    byte_ids = list(range(256))
    spanning = pieces.Vocabulary({"a▁b": (300, -1.0), "a": (301, -1.0), "▁": (302, -1.0), "b\n": (303, -1.0)}, byte_ids)
    assert spanning.cut is None
    assert spanning.encode("a b", pieces.Cache()).tolist() == [302, 300]
    assert spanning.encode("a b\n", pieces.Cache()).tolist() == [302, 301, 302, 303]  # a byte costs more than another piece
    blankless = pieces.Vocabulary({"a": (300, -1.0)}, byte_ids)
    assert blankless.decode(blankless.encode("a a▁", pieces.Cache())) == "a a▁"
    empty = pieces.Vocabulary({}, byte_ids)
    assert empty.decode(empty.encode("é b", pieces.Cache())) == "é b"


def test_cache_stays_bounded(monkeypatch, known):
    monkeypatch.setattr(pieces, "CACHED", 10)
    monkeypatch.setattr(pieces, "PASSING", 5)
    cache = pieces.Cache()
    for i in range(50):
        text = f"early late{i} more{i * 7}"
        assert known.decode(known.encode(text, cache)) == text
        assert len(cache) <= 10 + 5 + 6
    assert " early".replace(" ", pieces.BLANK) in cache


def test_dirty_rows(make_docs, clashing):
    docs = make_docs([(i, t) for i, t in enumerate([*ODD, None, "the", "the"])])
    docs = clashing(docs, "piece_ids", "decoded", "same")
    rows = {r.doc_id: r for r in pieces.round_trip(docs).collect()}
    n = len(ODD)
    assert all(rows[i].same for i in range(n)) and rows[0].piece_ids == [] and rows[0].n_pieces == 0
    assert (rows[n].piece_ids, rows[n].n_pieces, rows[n].same) == (None, None, None)
    assert rows[n + 1].piece_ids == rows[n + 2].piece_ids and rows[0].decoded == "extra decoded"
    assert pieces.round_trip(docs.limit(0)).collect() == []


def test_summary_matches_the_ids(make_docs):
    docs = make_docs([(i, t) for i, t in enumerate([*ODD, None])])
    ids = {r.doc_id: r.piece_ids for r in pieces.encode(docs).collect()}
    for r in pieces.summary(docs).collect():
        found = ids[r.doc_id]
        digest = None if found is None else hashlib.sha256(struct.pack(f"<{len(found)}i", *found)).hexdigest()
        assert (r.n_pieces, r.ids_sha256, r.same) == ((None, None, None) if found is None else (len(found), digest, True))


def test_registered_query(spark, sf_dir):
    rows = op5_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(r.same and r.n_pieces > 0 for r in rows)
