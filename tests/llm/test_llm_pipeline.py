import pytest

import corpus_pipeline
from roamsight.llm import toxicity
from roamsight.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """What every stage returns, each written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, found = table(spark, sf_dir, "documents"), []
    found.append(docs)
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / f"{number}-{name}")
        function(spark, found[-1], sf_dir).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_ids(steps):
    for before, after in zip(steps, steps[1:], strict=False):
        assert after.columns[: len(COLUMNS)] == COLUMNS
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(rows(before))
    assert [s.columns for s in steps[:-1]] == [COLUMNS] * 5


def test_toxic_documents_go(spark, sf_dir, steps):
    model = toxicity.train(steps[0], table(spark, sf_dir, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.scored(steps[0], model).collect()}
    before = rows(steps[0])
    assert rows(steps[1]) == {i: before[i] for i in scores if scores[i] < 0.3}


def test_one_document_of_each_group_stays(steps):
    from test_llm_simhash import groups, naive

    before, after = rows(steps[1]), rows(steps[2])
    ids = sorted(before)
    parent = groups([naive(before[i].text, 3) for i in ids], lambda a, b: (a ^ b).bit_count() <= 3)
    assert after == {ids[p]: before[ids[p]] for p in set(parent)}
    assert len(after) < len(before)


def later_copies(docs, n=51):
    """Words of each text (in order of ids) that stand in n words which stood before."""
    seen, gone = set(), {}
    for i in sorted(docs):
        found = docs[i].text.encode().split()
        gone[i] = [False] * len(found)
        for a in range(len(found) - n + 1):
            window = tuple(found[a : a + n])
            if window in seen:
                gone[i][a : a + n] = [True] * n
            seen.add(window)
    return gone


def test_repeated_passages_go_but_for_the_first(steps):
    before, after = rows(steps[2]), rows(steps[3])
    assert before.keys() == after.keys()
    gone = later_copies(before)
    assert any(any(g) for g in gone.values())
    for i, r in before.items():
        kept = [w for w, g in zip(r.text.encode().split(), gone[i], strict=True) if not g]
        assert after[i].text.encode().split() == kept and after[i].n_chars == len(after[i].text)
        assert any(gone[i]) or after[i] == r


def test_planted_passages_of_51_words_go(spark, make_docs, sf_dir):
    """Copies of 51 words and of 400 bytes or less, amid other words, stay once; 50 words stay everywhere."""
    new = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    passage, short = new("p", 51), new("q", 50)
    assert len(passage) < 400
    around = lambda i, text: f"{new(f'a{i}x', 20 + i)} {text} {new(f'b{i}x', 30)}"
    docs = make_docs([(i, around(i, passage)) for i in range(20)] + [(i, around(i, short)) for i in range(20, 40)])
    left = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, docs, sf_dir).collect()}
    assert [i for i in left if passage in left[i].text] == [0]
    assert all(left[i].text.split() == around(i, "").split() for i in range(1, 20))
    assert all(left[i].text == around(i, short) for i in range(20, 40))


def test_benchmark_passages_go(spark, sf_dir, steps):
    from test_llm_decontaminate import words

    windows = set()
    for r in table(spark, sf_dir, "benchmark").collect():
        found = words(r.text)
        windows |= {tuple(found[a : a + 10]) for a in range(max(1, len(found) - 9))}
    before, after = rows(steps[3]), rows(steps[4])
    for i, r in before.items():
        found = words(r.text)
        hit = any(tuple(found[a : a + 10]) in windows for a in range(len(found)))
        assert hit or after[i] == r
        if hit and i in after:
            left = words(after[i].text)
            assert len(left) < len(found) and after[i].n_chars == len(after[i].text)


def test_encoding_gives_the_text_back(steps):
    assert steps[5].where("not same").count() == 0
    assert rows(steps[5].select(COLUMNS)) == rows(steps[4])


def test_run_gives_the_same(spark, sf_dir, steps):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(steps[5])


def test_dirty_documents(spark, sf_dir):
    text = "one two three four five six seven"
    docs = [(None, text, None, None, None), (1, None, "en", None, 3), (1, None, "en", None, 3), (2, "", "en", "s", 0), (3, "x " * 50_000, "en", "s", 1)]
    docs = spark.createDataFrame(docs, table(spark, sf_dir, "documents").schema)
    for frame in (docs, docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            frame = function(spark, frame, sf_dir)
        assert frame.count() <= 5


def test_columns_with_clashing_names_stay(spark, sf_dir, make_docs, clashing):
    """Names that stages use on the way come through all but the last, whose own results replace them."""
    names = ["score", "fingerprint", "component", "digest", "spans", "cut", "items", "kept", "id", "label", "toxic"]
    frame = clashing(make_docs([(1, "one two three"), (2, "four five six"), (2, "four five six"), (None, "seven eight")]), *names)
    for _, function in corpus_pipeline.STAGES[:-1]:
        frame = function(spark, frame, sf_dir)
        assert frame.columns == [*COLUMNS, *names]
    assert {r["component"] for r in frame.collect()} == {"extra component"}
