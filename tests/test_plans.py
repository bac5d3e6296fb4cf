import json
import os

import pytest
from pyspark.sql import functions as F

from taskmill.operators import adapters, ordering, prepare, subjects
from taskmill.sources import config, lines, sinks
from taskmill.sources.schema import TASK_COLUMNS

TOML = """
merge_output_file = "all.jsonl"
[[sources]]
name = "one"
provider = "local_jsonl"
adapter = "question_pool_mcq"
[sources.local_jsonl]
path = "one.jsonl"
[[sources]]
name = "two"
provider = "huggingface"
adapter = "trivia_qa_rc"
enabled = false
[sources.huggingface]
repo_id = "depot/two"
"""


def read(spark, *objs):
    rows = [(i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objs)]
    out = lines.tasks_from_lines(spark.createDataFrame(rows, "id int, line string"))
    return {r["id"]: r for r in out.collect()}


def test_reader_keys_absent_and_null(spark):
    mc = {"choices": ["a", " ", "b"], "answer": "b"}
    got = read(
        spark, {"question": "q", "answer": "a"}, {"question_text": None, "question": "q", "answer": "a"}, {"question": " q ", **mc}, {"question": "q", **mc, "answer_index": "B"},
        {"question": "q", **mc, "answer_index": 5}, "", "not json", "[1]", {"question": "q", "gold_answer": True, "id": " ", "seed_id": 7, "split": " "},
        {"contract": "world_question_v1", "question": "q", "answer": "a", "benchmark_name": "bb", "metadata": {"x": 1}}, {"question": "q", "answer": "a", "contract": "other"},
        {"question": "q", "answer": "a", "metadata": [1]}, {"question": "q", "answer": "a", "choices": "no list"}, {"question": "q", "answer": "a", "question_type": " Open_QA "},
    )
    assert 5 not in got
    assert got[0]["error"] is None and got[0]["data_split"] == "train" and got[0]["domain"] == "unknown" and got[0]["question_type"] == "open_qa"
    assert got[1]["error"] == "no question_text"
    assert got[2]["choices"] == ["a", "b"] and got[2]["reference_answer_index"] == 1 and got[2]["question_text"] == "q"
    assert got[3]["reference_answer_index"] == 1 and got[4]["error"] == "multiple_choice without a valid index"
    assert got[6]["error"] == "not JSON" and got[7]["error"] == "not an object"
    assert got[8]["reference_answer"] == "True" and got[8]["question_id"] == "7" and got[8]["data_split"] == "train"
    assert json.loads(got[9]["metadata"]) == {"x": 1, "benchmark_name": "bb"}
    deep = {"x": {"y": 1, "z": [{"w": None}]}, "benchmark_name": "old", "s": "}}"}
    row = {"contract": "world_question_v1", "question": "q", "answer": "a", "metadata": deep}
    more = read(spark, row | {"benchmark_name": 'b"n'}, row, row | {"metadata": {}}, {"question": "q", "answer": 1.0}, {"question": "q", "answer": 2.5}, {"question": 12, "answer": False},
                {"question": "q", **mc, "answer_index": 20_000_000_000}, {"question": "q", **mc, "answer_index": "9" * 40}, {"question": "q", **mc, "answer_index": -(10**15)})
    assert [json.loads(more[i]["metadata"]) for i in range(3)] == [deep | {"benchmark_name": 'b"n'}, deep, {"benchmark_name": None}]
    assert [more[i]["reference_answer"] for i in (3, 4, 5)] == ["1.0", "2.5", "False"] and more[5]["question_text"] == "12"
    odd = read(spark, "12", '"text"', "null", '{"a": 1} x', "[1] [2]", '"a" "b"', "12 13", "-1.5e3", "nul")
    assert [odd[i]["error"] for i in range(9)] == ["not an object"] * 3 + ["not JSON"] * 4 + ["not an object", "not JSON"]
    assert {more[i]["error"] for i in (6, 7, 8)} == {"multiple_choice without a valid index"}
    assert got[10]["error"] == "unsupported contract" and got[11]["error"] == "metadata is no object" and got[12]["error"] == "choices is no list"
    assert got[13]["question_type"] == "open_qa" and got[0]["question_id"].startswith("task::")


def test_checked_fails_on_a_bad_row(spark):
    rows = lines.tasks_from_lines(spark.createDataFrame([("{}",)], "line string"))
    with pytest.raises(Exception, match="bad row"):
        lines.checked(rows).collect()
    assert lines.accepted(rows).count() == 0


def test_pool_reader(spark):
    good = {k: "x" for k in ("source_dataset", "source_split", "subject", "question", "answer", "prompt_text")} | {"choices": ["a"], "answer_index": None, "meta": {}}
    cases = [good, good | {"choices": [1]}, good | {"answer_index": "1"}, good | {"meta": None}, good | {"subject": None}, good | {"answer_index": True}]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "id int, line string")
    got = {r["id"]: r["error"] for r in lines.pool_from_lines(df).collect()}
    assert got == {0: None, 1: "invalid choices", 2: "invalid answer_index", 3: "invalid meta", 4: "missing string field subject", 5: None}


def test_line_numbers_over_files_and_blocks(spark, tmp_path):
    good = json.dumps({"question": "q", "answer": "a"})
    (tmp_path / "b.jsonl").write_text("\n".join([good, "", "{broken", good]) + "\n")
    (tmp_path / "a.jsonl").write_text("".join(f"{good}\n" for _ in range(500)) + "[1]\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many blocks a file
    try:
        rows = lines.read_numbered(spark, str(tmp_path))
        got = [(r["source_file"][-7:], r["line_no"], r["row_pos"]) for r in rows.orderBy("row_pos").collect()]
        errors = {r["error"] for r in lines.tasks_from_lines(rows).filter("error IS NOT NULL").collect()}
        pool = {r["error"] for r in lines.pool_from_lines(rows).filter("error LIKE '%not JSON' OR error LIKE '%object'").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("a.jsonl", i + 1, i) for i in range(501)] + [("b.jsonl", i + 1, 501 + i) for i in range(4)]
    assert errors == pool == {"line 501: not an object", "line 3: not JSON"}


def test_config(tmp_path):
    path = tmp_path / "set.toml"
    path.write_text(TOML)
    c = config.load_config(str(path))
    assert c.name == "set" and c.output_file == "all.jsonl" and c.sources[0].output_file == "one_tasks.jsonl" and not c.sources[1].enabled
    for bad in ("x = 1", "[[sources]]\nname = 'a'", "sources = [1]"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.load_config(str(path))
    assert config.split_names("validation") == ["validation", "val"]
    assert config.resolve_path(str(tmp_path), "set.toml") == str(tmp_path / "set.toml") and config.resolve_path(str(tmp_path), "none") == "none"


def test_interleave_is_a_permutation_and_honours_limits(spark):
    df = spark.createDataFrame([(i, "abc"[min(2, i % 5)] if i % 7 else None) for i in range(60)], "id int, g string")
    rows = df.collect()
    groups = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        groups.setdefault(r["g"] or "", []).append(r["id"])
    want, level = [], 0
    while len(want) < 60:
        want += [groups[g][level] for g in sorted(groups) if level < len(groups[g])]
        level += 1
    got = [r["id"] for r in ordering.interleaved(df, "g", ["id"]).orderBy("position").collect()]
    assert got == want
    assert [r["id"] for r in ordering.interleaved(df, "g", ["id"], 7).orderBy("position").collect()] == want[:7]
    with pytest.raises(ValueError):
        ordering.interleaved(df, "g", ["id"], 0)
    assert ordering.interleaved(df.limit(0), "g", ["id"]).count() == 0


def test_subject_ties_and_fallback(spark):
    labelled = spark.createDataFrame([("b_one", "tide tide moon"), ("a_two", "moon moon tide"), ("none", None)], "config string, text string")
    index = subjects.token_index(labelled, "config", "text")
    rows = spark.createDataFrame([(1, "tide"), (2, "moon tide"), (3, "zzz"), (4, None)], "id int, text string")
    for wide in (200, 1):
        subjects.WIDE, old = wide, subjects.WIDE
        got = {r["id"]: (r["config"], r["subject"], r["score"]) for r in subjects.infer_subject(rows, "id", "text", index).collect()}
        subjects.WIDE = old
        assert got == {1: ("b_one", "b one", 2), 2: ("a_two", "a two", 3), 3: (None, "general knowledge", 0), 4: (None, "general knowledge", 0)}


def test_adapters(spark):
    with pytest.raises(ValueError):
        adapters.build("other")
    rows = spark.createDataFrame([(1, "c1", " ", "q1", ["xx", "yy"], "yy"), (2, "c1", None, "q2", ["x"], "9"), (3, "c0", "S_x", "q3", None, "z")], "k int, config string, subject string, question string, choices array<string>, answer string")
    got = {r["question_id"]: r for r in adapters.build("mmlu_cais", rows, "n", "d", "dev", ["k"]).collect()}
    assert [got[f"n::dev::{i}"]["question_text"] for i in range(3)] == ["q3", "q1", "q2"]
    assert got["n::dev::1"]["domain"] == "c1" and got["n::dev::1"]["reference_answer_index"] == 1 and got["n::dev::2"]["reference_answer_index"] == 9
    t = spark.createDataFrame([(1, None, "q", None), (2, "", "q", ("v", ["w"], None))], "k int, question_id string, question string, answer struct<value:string,aliases:array<string>,normalized_aliases:array<string>>")
    [r] = adapters.build("trivia_qa_rc", t, "n", "d", "train", ["k"]).collect()
    assert r["question_id"] == "n::train::1" and r["reference_aliases"] == ["v", "w"]


def test_prepare_reuse_and_append(spark, tmp_path):
    path = tmp_path / "set.toml"
    path.write_text(TOML)
    c = config.load_config(str(path), str(tmp_path / "root"))
    line = json.dumps({"question": "q", "answer": "a"})
    built = []

    def build(source):
        built.append(source.name)
        return lines.accepted(lines.tasks_from_lines(spark.createDataFrame([(line,)], "line string"))).select(F.lit(0).alias("part"), F.lit(0).alias("position"), *TASK_COLUMNS)

    assert prepare.prepare(spark, c, build) == {"one": 1}
    assert prepare.prepare(spark, c, build, limit=1) == {"one": 1} and built == ["one"]
    assert prepare.prepare(spark, c, build, force=True) == {"one": 1} and built == ["one", "one"]
    again = lines.checked(lines.tasks_from_lines(lines.read_lines(spark, str(tmp_path / "root" / "all.jsonl")))).collect()
    assert again[0]["question_text"] == "q"
    assert lines.read_lines_if_any(spark, str(tmp_path / "nothing")).count() == 0
    new = sinks.append_new(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int"), "k")
    assert [r[0] for r in new.collect()] == [1]
    sinks.write_json({"b": 1, "a": 2}, str(tmp_path / "x" / "y.json"))
    assert list(json.load(open(tmp_path / "x" / "y.json"))) == ["a", "b"] and os.listdir(tmp_path / "x") == ["y.json"]
    with pytest.raises(ValueError):
        prepare.merged([new], ["k"], 0)


def test_entry_registers_queries_with_sql():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and len(q) > 30
    assert callable(e.entry)
    assert F is not None


def test_adapters_of_all_splits(spark):
    rows = spark.createDataFrame(
        [(1, "validation", "c1", "coral", "a"), (2, " VAL ", "c1", "q2", "a"), (3, "dev", "c0", "tide moon", "a"), (4, "Auxiliary_Train ", None, "tide", "a"), (5, "auxiliary_train", None, "zzz", "a"), (6, "train", "c1", "q6", "a"), (7, None, "c1", "q7", "a")],
        "k int, split string, config string, question string, answer string",
    ).withColumns({"subject": F.col("config"), "choices": F.array(F.lit("a"), F.lit("b"))})
    got = {r["question_id"]: (r["question_text"], r["data_split"], r["domain"]) for r in adapters.build("mmlu_cais", rows, "n", "d", None, ["k"]).collect()}
    assert got == {
        "n::auxiliary_train::0": ("tide", "auxiliary_train", "c0"), "n::auxiliary_train::1": ("zzz", "auxiliary_train", "general knowledge"),
        "n::dev::0": ("tide moon", "dev", "c0"), "n::validation::0": ("coral", "validation", "c1"), "n::validation::1": ("q2", "validation", "c1"),
    }
    assert adapters.build("mmlu_cais", rows, "n", "d", None, ["k"], 1).count() == 3
    t = spark.createDataFrame(
        [(1, "train", None, ("v", [], [])), (2, "Train", "x", ("v", [], [])), (3, "val", "", ("v", [], [])), (4, "validation", "y", None), (5, "validation", "z", ("v", [], [])), (6, "test", "w", ("v", [], []))],
        "k int, split string, question_id string, answer struct<value:string,aliases:array<string>,normalized_aliases:array<string>>",
    ).withColumn("question", F.lit("q"))
    got = [(r["question_id"], r["data_split"]) for r in adapters.build("trivia_qa_rc", t, "n", "d", None, ["k"]).collect()]
    assert sorted(got) == [("n::train::0", "train"), ("n::validation::0", "validation"), ("x", "train"), ("z", "validation")]
    assert adapters.build("trivia_qa_rc", t, "n", "d", None, ["k"], 1).count() == 2


COMMAND = """
[[sources]]
name = "pool"
provider = "local_jsonl"
adapter = "question_pool_mcq"
[sources.local_jsonl]
path = "pool.jsonl"
[[sources]]
name = "bench"
provider = "huggingface"
adapter = "mmlu_cais"
[sources.huggingface]
repo_id = "depot/bench"
[[sources]]
name = "quiz"
provider = "huggingface"
adapter = "trivia_qa_rc"
[sources.huggingface]
repo_id = "depot/quiz"
"""


def dataset(spark, root):
    pool = {"source_dataset": "d", "source_split": "dev", "subject": "s_s", "choices": ["a", "b"], "answer": "a", "answer_index": 0, "prompt_text": "p", "meta": {"k": {"n": None}}}
    root.mkdir(parents=True)
    (root / "pool.jsonl").write_text("".join(json.dumps(pool | {"question": f"q{i}"}) + "\n" for i in range(25)))
    bench, quiz = root / "depot" / "bench", root / "depot" / "quiz"
    mmlu = "config string, subject string, question string, choices array<string>, answer string"
    def save(rows, schema, path):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
    save([("all", None, f"tide {i}", ["a", "b"], "b") for i in range(3)], mmlu, bench / "train.parquet")  # the other name of auxiliary_train
    save([("sea", "sea", "tide tide", ["x"], "0"), ("sky", None, "star", ["x", "y"], "B"), ("all", None, "none", ["x"], "x")], mmlu, bench / "dev.parquet")
    save([("sea", None, "moon", ["x"], "a")], mmlu, bench / "val.parquet")
    for split in ("train", "validation"):
        (quiz).mkdir(exist_ok=True)
        (quiz / f"{split}.jsonl").write_text("\n".join(json.dumps({"question": f"{split}{i}", "question_id": None, "answer": None if i == 1 else {"value": "v", "aliases": ["w"]}}) for i in range(3)) + "\n")
    (root / "set.toml").write_text(COMMAND)


def test_prepare_command(spark, tmp_path, capsys):
    root = tmp_path / "set"
    dataset(spark, root)
    args = ["--dataset-config-path", str(root / "set.toml"), "--dataset-root", str(root)]
    assert prepare.main(args, spark) == {"pool": 25, "bench": 6, "quiz": 4}
    out = capsys.readouterr().out
    assert f"rows_written=35\noutput_path={root}/tasks.jsonl\nsource=bench rows=6\nsource=pool rows=25\nsource=quiz rows=4" in out
    rows = prepare.read_tasks(spark, str(root / "tasks.jsonl")).orderBy("position").collect()
    want = [f"pool::dev::{i}" for i in range(25)] + [f"bench::auxiliary_train::{i}" for i in range(3)] + ["bench::dev::0", "bench::dev::1", "bench::validation::0"]
    assert [r["question_id"] for r in rows] == want + [f"quiz::{s}::{i}" for s in ("train", "validation") for i in (0, 2)]
    by_id = {r["question_id"]: r for r in rows}
    assert json.loads(by_id["pool::dev::24"]["metadata"])["source_meta"] == {"k": {"n": None}} and by_id["pool::dev::24"]["question_text"] == "q24"
    meta = json.loads(by_id["bench::auxiliary_train::2"]["metadata"])
    assert meta["source_meta"] == {"source_subset": "all", "subject_source": "inferred_from_labeled_splits", "subject_inference_score": 2, "source_subject_config": "sea", "original_answer": "b", "answer_label": "B"}
    assert by_id["bench::dev::1"]["reference_answer"] == "y" and by_id["bench::dev::1"]["domain"] == "sky"
    # A reused source is whole; the limit takes the first merged rows in order.
    assert prepare.main([*args, "--limit", "12", "--output-path", str(root / "few.jsonl")], spark) == {"pool": 25, "bench": 6, "quiz": 4}
    few = prepare.read_tasks(spark, str(root / "few.jsonl")).orderBy("position").collect()
    assert [r["question_id"] for r in few] == want[:12]
    assert prepare.main([*args, "--limit", "2", "--force", "--output-path", str(root / "two.jsonl")], spark) == {"pool": 2, "bench": 5, "quiz": 4}
    with pytest.raises(SystemExit):
        prepare.main([], spark)


def test_tasks_are_prepared_if_missing(spark, tmp_path):
    root = tmp_path / "set"
    dataset(spark, root)
    with pytest.raises(FileNotFoundError):
        prepare.ensure_tasks(spark, str(root / "other.jsonl"))
    with pytest.raises(FileNotFoundError):
        prepare.ensure_tasks(spark, str(root / "tasks.jsonl"))
    got = prepare.ensure_tasks(spark, str(root / "tasks.jsonl"), str(root / "set.toml"), 26).orderBy("position").collect()
    assert [r["question_id"] for r in got] == [f"pool::dev::{i}" for i in range(25)] + ["bench::auxiliary_train::0"]
    assert not (root / "quiz_tasks.jsonl").exists()  # the limit was reached before
    assert prepare.ensure_tasks(spark, str(root / "tasks.jsonl")).count() == 26


def test_index_cache_and_empty_configurations(spark, tmp_path):
    path, built = str(tmp_path / "index.parquet"), []

    def build(rows):
        built.append(len(rows))
        return spark.createDataFrame(rows, subjects.INDEX_SCHEMA)

    assert subjects.cached_index(spark, path, lambda: build([])).count() == 0
    assert subjects.cached_index(spark, path, lambda: build([("c", "tide", 2)])).count() == 1  # an empty cache is built again
    assert subjects.cached_index(spark, path, lambda: build([])).count() == 1 and built == [0, 1]
    with pytest.raises(ValueError, match="'d'"):
        subjects.checked_index(spark.read.parquet(path), spark.createDataFrame([("c",), ("d",)], "config string"))
    with pytest.raises(ValueError):
        adapters.subject_rows(spark.createDataFrame([("all",)], "config string"))


def test_sample_records(spark):
    rows = spark.createDataFrame([(i, f" q{i} ", [" a", "b "], a) for i, a in enumerate(["b", "a", "1", "z", "B"])], "k int, question string, choices array<string>, answer string")
    got = prepare.sample_records(rows, ["k"], 1, 3, "sub").collect()
    assert [tuple(r) for r in got] == [("mmlu_000001", "sub", "q1", ["a", "b"], "A"), ("mmlu_000002", "sub", "q2", ["a", "b"], "B"), ("mmlu_000003", "sub", "q3", ["a", "b"], "z")]
    assert prepare.sample_records(rows, ["k"], 9, 3, "sub").count() == 0
    assert [r["subject"] for r in prepare.sample_records(rows.withColumn("subject", F.lit(" s ")), ["k"], 0, 1, "sub").collect()] == ["s"]
