import random

import corpus_pipeline


def test_each_stage_keeps_its_promise(spark, tmp_path, monkeypatch):
    tables = {}

    def kept_table(df, name, written=corpus_pipeline.written):
        tables[name] = written(df, name)
        return tables[name]

    monkeypatch.setattr(corpus_pipeline, "written", kept_table)
    monkeypatch.setattr(corpus_pipeline, "discard_others", lambda *keep: None)  # the stages are looked at below
    r = random.Random(6)
    names = ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(names) for _ in range(n))
    item = prose(40)
    texts = [prose(r.randint(60, 200)) for _ in range(120)]
    texts += [texts[0], texts[1] + " end", "short", None, f"{prose(60)} {item} {prose(20)}", f"{prose(60)} password = hunter2222 {prose(20)}"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    gone = set(range(len(texts))) - set(kept)
    assert {120, 121, 122, 123, 124} <= gone and len(gone) <= 8
    assert [name for name, _ in corpus_pipeline.STAGES[:-1]] == list(tables)
    ids = [{r.doc_id for r in docs.collect()} for docs in tables.values()]
    assert all(docs.columns == corpus_pipeline.COLUMNS for docs in tables.values())
    assert 122 not in ids[0] and 123 not in ids[0] and {0, 120, 124} <= ids[0]
    assert 120 not in ids[1] and 121 not in ids[1] and {0, 1, 124} <= ids[1]
    assert 124 not in ids[2] and ids[3] == ids[2] == set(kept)
    masked = tables["secret_scan"].filter("doc_id = 125").first()
    assert "[secret]" in masked.text and "hunter2222" not in masked.text and masked.n_chars == len(masked.text)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k long, cid string, n long"


def folder_with(spark, tmp_path, docs, items):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, folder_with(spark, tmp_path, spark.createDataFrame([], SCHEMA), []))
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_repeated_rows_nulls_and_clashing_columns(spark, tmp_path):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(500)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    item, same = prose(30), prose(80)
    texts = [(None, prose(60)), (None, None), (1, ""), (2, same), (2, same), (3, same), (4, f"{prose(30)} {item}"), (4, f"{prose(30)} {item}"), (5, "token = abcdef123"), (5, "token = abcdef123"), (6, "long " * 30000), (None, prose(60))]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or ""), 7, "x", 3) for i, t in texts], SCHEMA)
    path = folder_with(spark, tmp_path, docs, [(1, item)])
    stages = dict(corpus_pipeline.STAGES)
    ids = {name: sorted((x.doc_id if x.doc_id is not None else -1) for x in stage(spark, docs, path).collect()) for name, stage in stages.items()}
    every = sorted(-1 if i is None else i for i, _ in texts)
    assert ids["secret_scan"] == ids["bpe_encoding"] == every
    assert ids["decontamination"] == [i for i in every if i != 4]
    assert ids["jaccard_join"].count(2) == 1 and 3 not in ids["jaccard_join"] and ids["jaccard_join"].count(4) >= 1
    assert ids["quality_rules"].count(2) in (0, 2) and 1 not in ids["quality_rules"]
    masked = [x for x in stages["secret_scan"](spark, docs, path).collect() if x.doc_id == 5]
    assert len(masked) == 2 and all("abcdef123" not in x.text for x in masked)
    assert all(stage(spark, docs, path).columns == corpus_pipeline.COLUMNS for name, stage in corpus_pipeline.STAGES[:-1])
