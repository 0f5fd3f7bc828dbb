"""Stages of the corpus pipeline over null and repeated ids."""

import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from daystrata.llm import language

STRANGE = "зъж кчщ юыэ " * 30


@pytest.fixture(scope="module")
def docs(spark, folder):
    """Clean documents, some without id, repeated ones, and rejected texts under null, own and used ids."""
    clean = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*pipeline.COLUMNS).limit(300).collect()]
    rows = [(None, *r[1:]) if k % 10 == 0 else r for k, r in enumerate(clean)]
    rows += [rows[0], rows[1], (rows[2][0], STRANGE, "en", "s", 1), (None, STRANGE, None, None, None), (-1, None, "en", "s", 1), (-2, "", None, "s", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_languages_judges_each_row_itself(spark, folder, docs):
    model = language.fit(docs)
    rows = [tuple(r) for r in docs.collect()]
    fine = model.predict([r[1] for r in rows])[3]
    expected = Counter(r for r, good in zip(rows, fine) if good)
    found = counted(pipeline.languages(spark, docs, folder).collect())
    assert found == expected
    assert sum(n for r, n in found.items() if r[0] is None) > 20 and not any(r[1] == STRANGE for r in found)
    assert pipeline.languages(spark, docs.limit(0), folder).count() == 0


def plain_rules(text):
    """Whether the quality rules keep a text, word by word."""
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = len({i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)})
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or ""))
    return not (
        n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or (len(lines) >= 8 and 10 * (len(lines) - len(set(lines))) > 3 * len(lines))
        or 10 * sum(a == b for a, b in zip(words, words[1:])) > 3 * n or chars < 2 * n or chars > 20 * n
        or 10 * sum(w == w.upper() and w != w.lower() for w in words) > 3 * n)


def test_quality_judges_each_row(spark, folder, docs):
    expected = Counter(tuple(r) for r in docs.collect() if plain_rules(r["text"]))
    assert counted(pipeline.quality(spark, docs, folder).collect()) == expected
    assert pipeline.quality(spark, docs.limit(0), folder).count() == 0


def test_one_row_of_each_class_stays(spark, folder):
    words = [f"word{k}" for k in range(200)]
    text, near = " ".join(words), " ".join(words[:199] + ["other"])
    rows = [(1, text, "en", "s", 1)] * 5 + [(None, text, "en", "s", 1)] * 4 + [(2, text, "de", "t", 1), (3, near, "en", "s", 1), (3, "short one", "en", "s", 1)]
    rows += [(4, " ".join(f"own{k}" for k in range(50)), None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [tuple(r) for r in pipeline.near_duplicates(spark, df, folder).collect()]
    assert sum(r[1] in (text, near) for r in kept) == 1 and len(kept) == 5
    assert pipeline.near_duplicates(spark, df.limit(0), folder).count() == 0


def test_whole_run_beside_its_stages(spark, folder, docs, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = pipeline.run(spark, str(tmp_path)).collect()
    kept = [r for r in docs.collect() if plain_rules(r["text"])]
    fine = language.fit(spark.createDataFrame(kept, docs.schema)).predict([r["text"] for r in kept])[3]
    texts = {r["text"] for r, good in zip(kept, fine) if good}
    named = {r["doc_id"] for r in docs.collect() if r["text"] in texts}
    assert rows and {r["doc_id"] for r in rows} <= named
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in filled.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096
