"""The pipeline against its stages done by hand on a small table."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from goldweave.llm import jaccard, quality

SECRET = "token = 0a1b2c3d4e5f60718293a4b5"


def documents():
    draw = random.Random(9)
    words = [f"word{i}" for i in range(500)]
    rows = []
    for i in range(40):
        base = [draw.choice(words) for _ in range(draw.choice([12, 60, 200]))]
        rows.append(" ".join(base))
        if i % 4 == 0:
            rows.append(" ".join(base))  # a copy
        if i % 5 == 0 and len(base) > 100:
            rows.append(" ".join([*base[:-1], "changed"]))  # a near copy
    rows[7] += f" {SECRET} end"
    rows += [None, "", "too short", "again and again " * 50]
    return [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(rows)]


def test_pipeline(spark, tmp_path):
    rows = documents()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()

    good = {i: t for i, t, *_ in rows if t is not None
            and (m := quality.measure(t, (5,)))[0] >= 10 and 100 * m[4] <= 20 * m[0]}
    sets = {i: set(zip(*[jaccard.words_of(t)[k:] for k in range(5)])) for i, t in good.items()}
    kept = [i for i in good if not any(
        j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in good)]
    assert {p.doc_id for p in pieces} == set(kept)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for i in kept:
        ids = tokenizer.encode(good[i].replace(SECRET, "[secret]"), add_special_tokens=False).ids + [1]
        for p in by_doc[i]:
            part = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part) and p.doc_tokens == len(ids)
        assert sum(p.length for p in by_doc[i]) == len(ids)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    rows = [(1, "x", "en", "s", 1, 0), (None, None, None, None, None, 1), (1, "x", "en", "s", 1, 2),
            (2, "a b c d e f g h i j k l m n " + SECRET, "en", None, 5, 3)]
    table = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for docs in (table, table.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == list(corpus_pipeline.DOCUMENT_COLUMNS)
    clean = {r.doc_id: r for r in corpus_pipeline.secret_scans(spark, table, "").collect()}
    assert clean[2].text.endswith("n [secret]") and clean[2].n_chars == len(clean[2].text)
    assert clean[1].n_chars == 1


def test_distinct_texts_under_one_id_are_kept(spark):
    draw = random.Random(4)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(6)]
    near = texts[0] + " more"
    rows = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:5]] + [
        (None, "bad"), (7, "bad"), (None, texts[0]), (7, texts[3]), (8, near), (7, texts[5].upper()),
        (7, texts[5]), (None, None), (7, "")]
    table = spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    clean = corpus_pipeline.quality_rules(spark, table, "")
    by_row = lambda docs: sorted(((r.doc_id or 0), r.text or "") for r in docs.collect())
    assert by_row(clean) == sorted((i or 0, t) for i, t in rows if t and len(t) > 10)
    found = by_row(corpus_pipeline.ngram_jaccard(spark, clean, ""))
    one = [t for _, t in found if t.lower() == texts[5]]
    assert len(one) == 1
    assert found == sorted([(0, texts[1]), (0, texts[2]), (7, texts[3]), (7, texts[4]), (7, one[0]), (8, near)])
