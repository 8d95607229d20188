import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from roamsight.llm import licences
from roamsight.llm.common import table
from roamsight.llm.licence_texts import KNOWN
from roamsight.llm.queries import op10_licences

MIT = next(text for name, text in KNOWN if name == "MIT")


@pytest.fixture(scope="module")
def known(spark):
    return licences.known_digests(spark)


def test_equivalent_forms(make_docs, known):
    forms = [
        MIT,
        MIT.upper(),
        "Copyright (c) 2020 Some One\n\n" + MIT,
        " * © 2020 Some One\n * All rights reserved.\n" + MIT.replace("\n", "\n * "),
        MIT.replace('"', "“", 1).replace('"', "”", 1).replace(" ", "  ") + "\n\n",
        "released under the mit licence",
        MIT + " More words.",
        MIT.replace("hereby ", ""),
    ]
    rows = {r.doc_id: r for r in licences.scan(make_docs(list(enumerate(forms))), known).collect()}
    assert [rows[i].licence for i in range(len(forms))] == ["MIT"] * 6 + [None, None]
    assert len({rows[i].canonical_sha256 for i in range(5)}) == 1


def test_lines(make_docs, known):
    text = "Some words.\nLicensed under the Apache License, Version 2.0.\r\n  RELEASED under the MIT license\nThe MIT License. No."
    rows = licences.scan(make_docs([(1, text), (2, text), (3, "MIT")]), known).collect()
    assert {r.doc_id: (r.licence, r.line_licences) for r in rows} == {1: (None, ["Apache-2.0", "MIT"]), 2: (None, ["Apache-2.0", "MIT"]), 3: (None, [])}


TEXTS = [(name, text) for name, text in KNOWN if len(text) > 200]


def test_known_texts_in_any_wrapping(make_docs, known):
    """Also on one line, and behind names of holders there or on lines of their own."""
    forms, expected = [], []
    for name, text in TEXTS:
        words = " ".join(text.split())
        made = ["\n".join(textwrap.wrap(words, width, break_long_words=False)) for width in (40, 80, 1000)]
        made += [f"© 2020 A. B. <a@b.c>\n{text}", f"Copyright 2019, 2020 The A Authors\nCopyright © B\nAll rights reserved.\n\n{text}"]
        if any(words.lower().startswith(opening) for opening in licences.OPENINGS):
            made.append(f"Copyright (c) 2020-2024 Some One, Inc. All rights reserved. {words}")
        forms += made
        expected += [name] * len(made)
    rows = {r.doc_id: r.licence for r in licences.scan(make_docs(list(enumerate(forms))), known).collect()}
    assert [rows[i] for i in range(len(forms))] == expected


def test_no_line_may_be_missing(make_docs, known):
    """A text without one of its lines is another text."""
    forms, kinds = [], []
    for name, text in TEXTS:
        lines = text.split("\n")
        for i, line in enumerate(lines):
            if line and i:
                forms.append("\n".join(lines[:i] + lines[i + 1 :]))
                kinds.append(name)
    rows = {r.doc_id: r.licence for r in licences.scan(make_docs(list(enumerate(forms))), known).collect()}
    assert [(kinds[i], rows[i]) for i in rows if rows[i]] == [("ISC", "0BSD")]  # which is just that


def test_sentences_about_holders_stay(spark):
    texts = ["copyright holders be liable", "the above copyright notice", "copyright owner 2020", "(c) you must retain", "copyright 2020 name", "x © y\nz", "(c) 1999 q\nr"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.c for r in frame.select("i", licences.canonical(F.col("t")).alias("c")).collect()}
    assert [found[i] for i in range(len(texts))] == ["copyright holders be liable", "the above copyright notice", "copyright holder 2020", "c you must retain", "", "x z", "r"]


def test_dirty_rows(make_docs, known, clashing, monkeypatch):
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, MIT), (None, MIT), (5, "...\n©"), (6, "licence " * 50_000)])
    docs = clashing(docs, "digest", "licence", "found", "key", "id", "known_licence", "known_digest")
    for limit in (licences.BROADCAST_ROWS, 0):  # broadcast and shuffled
        monkeypatch.setattr(licences, "BROADCAST_ROWS", limit)
        rows = licences.scan(docs, known).collect()
        found = sorted((r.doc_id or 0, r.licence or "", r.line_licences is None, r.found) for r in rows)
        extra = "extra found"
        assert found == [(0, "MIT", False, extra), (0, "MIT", False, extra), (1, "", True, extra), (2, "", False, extra), (2, "", False, extra), (5, "", False, extra), (6, "", False, extra)]
        assert next(r for r in rows if r.doc_id == 1).canonical_sha256 is None
    assert licences.scan(docs.limit(0), known).collect() == []


def test_no_known_licence(make_docs, spark):
    none = licences.known_digests(spark).limit(0)
    assert licences.scan(make_docs([(1, MIT)]), none).first().licence is None


def test_registered_query_against_sql(spark, sf_dir):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = sorted(db.sql(licences.oracle()).fetchall(), key=str)
    names = ["doc_id", "canonical_sha256", "licence", "line_licences"]
    assert sorted((tuple(r[n] for n in names) for r in op10_licences(spark, sf_dir).collect()), key=str) == expected
    assert len(expected) == table(spark, sf_dir, "documents").count()


def test_known_texts_and_sql_agree(make_docs, spark, tmp_path, known):
    more = ["Copyright (c) 2020 A Permission to use", "(c) you", "copyright 2020", "a\n© b\nc all rights reserved.", "Copyright, 1999 ©\n", "É ©x"]
    docs = make_docs([(i, text) for i, text in enumerate([text for _, text in KNOWN] + more)])
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    by_sql = {row[0]: (row[1], row[2]) for row in db.sql(licences.oracle()).fetchall()}
    by_spark = {r.doc_id: (r.canonical_sha256, r.licence) for r in licences.scan(docs, known).collect()}
    assert by_sql == by_spark
    assert [by_spark[i][1] for i in range(len(KNOWN))] == [name for name, _ in KNOWN]
