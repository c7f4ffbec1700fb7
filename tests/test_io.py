from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import exact, fuzzy, semantic, sft
from corpusloom.operators.ids import ensure_id
from corpusloom.operators.language import ngram_profiles, profile_scorer
from corpusloom.plans import catalog, oracle
from corpusloom.plans.config import CurationConfig, from_mapping, from_yaml
from corpusloom.plans.curate import Models, curate, funnel, pii_key, run_stages
from corpusloom.scratch import Scratch
from corpusloom.sources import documents, wiki


def write_lines(path, lines):
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


def test_jsonl_scan_keeps_bad_lines_apart(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"text": "one"}, "{not json", {"text": "two", "more": 1}])
    write_lines(tmp_path / "b.jsonl", [{"text": "three"}])
    schema = documents.document_schema()
    df = documents.read_jsonl(spark, str(tmp_path), schema)
    good = documents.well_formed(df)
    assert sorted(map(tuple, good.select("text", "file_name").collect())) == [
        ("one", "a.jsonl"), ("three", "b.jsonl"), ("two", "a.jsonl"),
    ]
    assert [tuple(r) for r in documents.malformed(spark, str(tmp_path), schema).collect()] == [("a.jsonl", 1)]


def test_late_ids_are_kept_and_missing_ones_filled(spark, scratch, tmp_path):
    lines = [{"text": f"t{i}"} for i in range(30)] + [{"id": f"x{i}", "text": f"u{i}"} for i in range(10)]
    write_lines(tmp_path / "a.jsonl", lines)
    schema = documents.document_schema(id_field="id")
    df = documents.well_formed(documents.read_jsonl(spark, str(tmp_path), schema))
    out = ensure_id(df, scratch, fill=True)
    rows = out.collect()
    assert out.columns == df.columns and len({r.id for r in rows}) == 40
    assert {r.id for r in rows if r.text.startswith("u")} == {f"x{i}" for i in range(10)}
    assert all(r.id.startswith("id-00000000") for r in rows if r.text.startswith("t"))
    assert ensure_id(df.limit(0), scratch, fill=True).count() == 0


def test_filled_ids_never_equal_given_ones(spark, scratch):
    rows = [("id-0000000001", "dup"), (None, "unique"), ("id-0000000000", "dup"), (None, "more"), ("id-7", "x"), ("id-00000000012", "y")]
    df = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    out = ensure_id(df, scratch, fill=True)
    got = {r.text: r.id for r in out.collect() if r.text in ("unique", "more")}
    assert got == {"unique": "id-0000000003", "more": "id-0000000005"}
    assert sorted(r.text for r in exact.exact_dedup(out, scratch).collect()) == ["dup", "more", "unique", "x", "y"]
    big = spark.createDataFrame([("id-" + "9" * 20, "a"), (None, "b"), ("id-" + "1" * 60, "c"), ("other-0000000009", "d")], "id string, text string")
    filled = {r.text: r.id for r in ensure_id(big, scratch, fill=True, order_by=["text"]).collect()}
    assert filled["b"] == "id-100000000000000000001"
    none = spark.createDataFrame([(None, "a"), (None, "b")], "id string, text string")
    assert sorted(r.id for r in ensure_id(none, scratch, fill=True).collect()) == ["id-0000000000", "id-0000000001"]


WHOLE = [
    {"id": 1, "text": "a", "tags": ["x", None, {"deep": [1.5, True]}], "a.b'c\"d": {"": "é"}},
    {"text": None, "id": "two", "n": 12345678901234567890123, "file_name": "mine"},
    {"id": "3"},
    {},
]


def test_whole_records_go_from_scan_to_sink(spark, scratch, tmp_path):
    (tmp_path / "in").mkdir()
    bad = ["{cut", "[1]", "5", '{"text": 1, "text": 2}', "null"]
    write_lines(tmp_path / "in" / "a.jsonl", [*WHOLE[:2], *bad[:2], "", "  "])
    write_lines(tmp_path / "in" / "b.jsonl", [*WHOLE[2:], *bad[2:]])
    df = scratch.save(documents.read_records(spark, str(tmp_path / "in"), "id string, text string"), "records")
    counts = {r.file_name: r.lines for r in documents.write_rejected(df, str(tmp_path / "bad")).collect()}
    assert counts == {"a.jsonl": 2, "b.jsonl": 3}
    kept = [line for p in (tmp_path / "bad").rglob("part-*") for line in p.read_text().splitlines()]
    assert sorted(kept) == sorted(bad)
    good = documents.accepted(df)
    assert sorted(((r.id, r.text) for r in good.select("id", "text").collect()), key=str) == [
        ("1", "a"), ("3", None), ("two", None), (None, None)
    ]
    changed = good.withColumn("text", F.upper("text")).withColumn("word_count", F.lit(2))
    documents.write_by_source(changed, str(tmp_path / "out"))
    back = {}
    for part in (tmp_path / "out").rglob("part-*"):
        for line in part.read_text().splitlines():
            back[json.loads(line).get("id")] = (part.parent.name, json.loads(line))
    assert back == {
        "1": ("file_name=a.jsonl", WHOLE[0] | {"id": "1", "text": "A", "word_count": 2}),
        "two": ("file_name=a.jsonl", WHOLE[1] | {"word_count": 2}),
        "3": ("file_name=b.jsonl", WHOLE[2] | {"word_count": 2}),
        None: ("file_name=b.jsonl", {"word_count": 2}),
    }


def test_sources_are_written_where_they_are_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        write_lines(tmp_path / "in" / f"{i}.jsonl", [{"text": "x" * 50}] * 40)
    df = documents.accepted(documents.read_records(spark, str(tmp_path / "in"), "text string"))
    documents.write_by_source(df, str(tmp_path / "out"))
    files = list((tmp_path / "out").rglob("part-*"))
    assert 12 <= len(files) <= df.rdd.getNumPartitions() + 12
    plan = df.select(documents.record_json(df, ["file_name"]), "file_name")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_scored_records_keep_their_fields(spark, scratch, tmp_path):
    write_lines(tmp_path / "in.jsonl", [{"input": "q", "output": "x" * n, "source": {"page": n}, "extra": None} for n in (2, 6)])
    df = documents.accepted(documents.read_records(spark, str(tmp_path / "in.jsonl"), "input string, output string", file_name=False))
    reward = sft.reward_struct({m: F.length("output") for m in sft.METRICS})
    documents.dual_sink(sft.with_overall(df.withColumn("reward", reward)), str(tmp_path / "out"), scratch)
    read = lambda name: [json.loads(x) for p in (tmp_path / "out" / name).glob("part-*") for x in p.read_text().splitlines()]
    assert read("filtered_data.jsonl") == [{"input": "q", "output": "xxxxxx", "source": {"page": 6}, "extra": None}]
    scored = read("sft_data_score.jsonl")
    assert {r["source"]["page"]: r["reward"]["overall"] for r in scored} == {2: 2.0, 6: 6.0}


def test_a_file_of_no_split_is_an_error(spark, tmp_path):
    write_lines(tmp_path / "other.jsonl", [{"input": "a", "output": "b"}])
    with pytest.raises(Exception, match="other.jsonl"):
        documents.read_splits(spark, str(tmp_path)).collect()


def test_several_paths_make_one_dataset(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        write_lines(tmp_path / name / "f.jsonl", [{"text": name}])
    paths = [str(tmp_path / "x"), str(tmp_path / "y")]
    df = documents.read_jsonl(spark, paths, documents.document_schema())
    assert sorted(r.text for r in df.collect()) == ["x", "y"]


def test_write_by_source_round_trip(spark, tmp_path):
    rows = [("1", "a", "f1.jsonl"), ("2", None, "f1.jsonl"), ("3", "c", "007")]
    df = spark.createDataFrame(rows, "id string, text string, file_name string")
    documents.write_by_source(df, str(tmp_path / "out"))
    back = spark.read.schema(df.schema).json(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("storage", ["json", "parquet"])
def test_languages_prune_to_one_directory(spark, tmp_path, storage):
    df = spark.createDataFrame([(1, "EN"), (2, "FR"), (3, "EN"), (4, None)], "id int, language string")
    path = str(tmp_path / "lang")
    stats = documents.write_by_language(df, path, storage=storage)
    assert {r.language: r.documents for r in stats.collect()} == {"EN": 2, "FR": 1, None: 1}
    one = documents.read_language(spark, path, df.schema, "en", storage)
    assert "PartitionFilters: [isnotnull(_part" in one._jdf.queryExecution().toString()
    assert sorted(r.id for r in one.collect()) == [1, 3]
    assert documents.read_language(spark, path, df.schema, storage=storage).count() == 4


def test_languages_end_in_few_files(spark, tmp_path):
    df = spark.range(0, 4000, numPartitions=40).select("id", F.array(F.lit("en"), F.lit("fr"), F.lit("de"))[(F.col("id") % 3).cast("int")].alias("language"))
    documents.write_by_language(df, str(tmp_path / "lang"))
    assert 3 <= len(list((tmp_path / "lang").rglob("part-*"))) <= 6


def test_languages_keep_whole_records(spark, scratch, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"id": "1", "text": "x", "more": [1, {"a": None}]}, {"id": "2", "text": "y"}])
    df = documents.accepted(documents.read_records(spark, str(tmp_path / "a.jsonl"), "id string, text string"))
    df = df.withColumn("language", F.when(F.col("id") == "1", "FR").otherwise("EN"))
    stats = documents.write_by_language(df, str(tmp_path / "lang"))
    assert {r.language: r.documents for r in stats.collect()} == {"FR": 1, "EN": 1}
    back = documents.read_language(spark, str(tmp_path / "lang"), df.schema, "fr")
    assert back.columns == df.columns
    (row,) = back.select("id", "text", "language", "file_name", documents.record_json(back).alias("j")).collect()
    assert (row.id, row.text, row.language, row.file_name) == ("1", "x", "FR", "a.jsonl")
    assert json.loads(row.j) == {"id": "1", "text": "x", "more": [1, {"a": None}], "language": "FR", "file_name": "a.jsonl"}
    # In shared storage as well, where one language is read from its folder.
    table = scratch.save(df.withColumn("_part", F.col("language")), "language", ["_part"]).where("_part = 'FR'")
    assert json.loads(table.select(documents.record_json(table.drop("_part")).alias("j")).first().j)["more"] == [1, {"a": None}]


def test_splits_by_file_name(spark, tmp_path):
    for name in ("training", "validation", "test"):
        write_lines(tmp_path / f"{name}.jsonl", [{"input": name, "output": "o"}])
    got = {r.input: r.split for r in documents.read_splits(spark, str(tmp_path)).collect()}
    assert got == {"training": "train", "validation": "validation", "test": "test"}


def test_dual_sink_scores_once(spark, scratch, tmp_path):
    df = spark.createDataFrame([("q", "x" * n) for n in (2, 6)], "input string, output string")
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def client(messages):
            calls.add(1)
            return {m: float(len(messages[1]["content"])) for m in sft.METRICS}

        return client

    scored = sft.with_overall(sft.score_pairs(df, factory))
    documents.dual_sink(scored, str(tmp_path), scratch)
    assert calls.value == 2
    read = lambda name: [
        json.loads(line)
        for part in sorted((tmp_path / name).glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert len(read("sft_data_score.jsonl")) == 2
    assert read("filtered_data.jsonl") == [{"input": "q", "output": "xxxxxx"}]
    assert {r["reward"]["overall"] for r in read("sft_data_score.jsonl")} == {2.0, 6.0}


DUMP = """<mediawiki>
<siteinfo><namespaces>
<namespace key="-2" case="first-letter">Medium</namespace>
<namespace key="6" case="first-letter">Datei</namespace>
<namespace key="14" case="first-letter">Kategorie</namespace>
</namespaces></siteinfo>
<page><title>Some Page</title><ns>0</ns><id>7</id><revision><id>1</id>
<text bytes="9" xml:space="preserve">'''Bold''' [[x|y]] [[Datei:a.png|b [[c]]]] [[Kategorie:D]]</text></revision></page>
<page><title>Old</title><ns>0</ns><id>8</id><redirect title="Some Page" />
<revision><text xml:space="preserve">#REDIRECT</text></revision></page>
<page><title>Talk:X</title><ns>1</ns><id>9</id><revision><text xml:space="preserve">t</text></revision></page>
</mediawiki>"""


def test_wiki_dump(spark, tmp_path):
    for name in ("d1.xml", "d2.xml"):
        (tmp_path / name).write_text(DUMP)
    rows = wiki.read_dump(spark, f"{tmp_path}/d*.xml", "xx", url_limit=1).collect()
    assert wiki.read_dump(spark, f"{tmp_path}/d*.xml", "xx").count() == 2
    assert [r.asDict() for r in rows] == [
        {"id": "7", "title": "Some Page", "url": "https://xx.wikipedia.org/wiki/Some_Page",
         "language": "xx", "text": "Bold y", "file_name": "d1.xml"}
    ]
    with pytest.raises(FileNotFoundError):
        wiki.read_dump(spark, f"{tmp_path}/none*.xml", "xx")


def test_configuration(tmp_path):
    path = tmp_path / "fuzzy.yaml"
    path.write_text("seed: 7\nfalse_positive_check: True\njaccard_threshold: 0.9\n")
    config = from_yaml(fuzzy.FuzzyConfig, str(path))
    assert (config.seed, config.false_positive_check, config.num_buckets) == (7, True, 20)
    with pytest.raises(ValueError):
        from_mapping(CurationConfig, {"clean": True})


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from corpusloom import scratch

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                sc = staticmethod(lambda: type("C", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})())

    with pytest.raises(RuntimeError):
        scratch.checkpoint_root(Cluster)
    assert scratch.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_curation_run(spark, scratch, tmp_path):
    filler = lambda i: " ".join(f"word{i * 100 + k}" for k in range(60))
    rows = [(filler(0), "f1"), (filler(0), "f1"), (filler(1) + " a@b.org", "f1"), ("short", "f2"), ("so so " * 40, "f2")]
    df = spark.createDataFrame(rows, "text string, file_name string")
    key = spark.createDataFrame([("0123456789abcdef",)], "k string").scalar()
    labelled = spark.createDataFrame([(filler(9), "en"), ("les chats et les chiens " * 9, "fr")], "text string, lang string")
    models = Models(language_scorer=profile_scorer(ngram_profiles(labelled)), pii_key=key)
    config = CurationConfig(
        cleaning=True, lid=True, language="en", heuristic=True, pii=True, pii_anonymize_action="encrypt",
        exact=True, fuzzy=True, semantic=True,
        semantic_config=semantic.SemanticConfig(n_clusters=3, embedding_model_name_or_path=semantic.BUILT_IN),
    )
    run = run_stages(df, config, scratch, models, str(tmp_path / "out"))
    counts = {r.stage: r.documents for r in funnel(spark, run).collect()}
    assert counts["input"] == 5 and counts["heuristic"] == 3 and counts["exact_duplicates"] == 2
    assert list(counts) and counts["semantic"] == 2
    assert all((tmp_path / "out" / stage).is_dir() for stage in counts if stage != "input")
    assert {p.name for p in (tmp_path / "out" / "language").glob("_part=*")} == {"_part=EN", "_part=FR"}
    stats = spark.read.json(str(tmp_path / "out" / "language_stats")).collect()
    assert {r.language: r.documents for r in stats} == {"EN": 5 - sum(r.documents for r in stats if r.language == "FR"), "FR": counts["input"] - counts["language"]}
    assert (tmp_path / "out" / "semantic_embeddings").is_dir()
    final = run.documents
    fused = run_stages(df, config, scratch, models)
    assert fused.counts == run.counts and fused.documents.count() == final.count()
    assert final.where(F.col("text").contains("a@b.org")).count() == 0
    assert {"id", "text", "file_name", "language", "word_count"} <= set(final.columns)
    with pytest.raises(ValueError):
        curate(df, CurationConfig(lid=True), scratch)


def test_two_tables_of_texts_at_most(spark, scratch, monkeypatch):
    """every stage's copy of the texts stayed until the end of the run."""
    words = lambda i: " ".join(f"word{i * 100 + k}" for k in range(60))
    rows = [(i, words(i % 9), "f") for i in range(12)] + [(12, "les chats et les chiens " * 9, "f")]
    df = spark.createDataFrame(rows, "id bigint, text string, file_name string")
    labelled = spark.createDataFrame([(words(9), "en"), (rows[-1][1], "fr")], "text string, lang string")
    paths, most, save = [], [0], Scratch.save

    def kept(self, df, name, *rest):
        table = save(self, df, name, *rest)
        if "text" in table.columns:
            paths.append(spark._jvm.org.apache.hadoop.fs.Path(self._tables[id(table)][1]))
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            most[0] = max(most[0], sum(p.getFileSystem(conf).exists(p) for p in paths))
        return table

    monkeypatch.setattr(Scratch, "save", kept)
    config = CurationConfig(cleaning=True, lid=True, language="en", heuristic=True, pii=True, exact=True, fuzzy=True)
    run = run_stages(df, config, scratch, Models(language_scorer=profile_scorer(ngram_profiles(labelled))))
    assert run.counts == [("input", 13), ("cleaning", 13), ("language", 12), ("heuristic", 12), ("pii", 12), ("exact_duplicates", 9), ("fuzzy_dedup", 9)]
    assert sorted(r.id for r in run.documents.collect()) == list(range(9))
    assert len(paths) == 2 and most[0] == 2
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert [p.getFileSystem(conf).exists(p) for p in paths] == [False, True]


def test_key_from_a_file(spark, tmp_path):
    (tmp_path / "key").write_text("00ff\n")
    row = spark.range(1).select(F.hex(pii_key(spark, str(tmp_path / "key"))).alias("k")).first()
    assert row.k == "00FF"


def test_catalogue_and_oracle_agree_on_names():
    assert set(catalog.QUERIES) == set(oracle.SQL)


def test_scratch_drop_and_close(spark):
    own = Scratch(spark)
    table = own.save(spark.range(3), "t")
    assert table.count() == 3
    own.drop(table)
    path = spark._jvm.org.apache.hadoop.fs.Path(own.root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own.close()
    assert not fs.exists(path)
