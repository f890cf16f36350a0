"""Refinement without a round cap, independent profiles, strict readers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import factor, graph, linear
from tessera.sources import readers, writers


def path_graph(spark, *sizes):
    edges, at = [], 0
    for n in sizes:
        edges += [(at + k, at + k + 1) for k in range(n - 1)]
        at += n
    return spark.createDataFrame(edges, "src long, dst long")


def test_paths_of_other_lengths_are_told_apart(spark):
    verdict = graph.compare_graphs(path_graph(spark, 20, 24), path_graph(spark, 22, 22)).first().verdict
    assert verdict == "not isomorphic"


def test_profiles_are_independent_normals(spark):
    ids = spark.range(1, 20_001)
    x = np.array(ids.select(*[factor.hashed_normal(F.col("id"), k, 7).alias(f"f{k}") for k in range(10)]).collect())
    assert abs(x.mean()) < 0.02 and abs(x.std() - 1) < 0.02
    assert np.abs(np.corrcoef(x.T) - np.eye(10)).max() < 0.03


def test_null_split_belongs_to_neither_side(spark):
    df = spark.createDataFrame([(1.0, 2.0, False), (2.0, 4.0, False), (1.0, 2.0, True), (1.0, 500.0, None)], "x double, y double, t boolean")
    assert abs(linear.lambda_sweep(df, ["x"], "y", "t", [0.0], 1000, 1e-8)[0]["beta"][0] - 2.0) < 1e-6


def test_edges_keep_quoted_text_and_refuse_other_lines(spark, tmp_dir):
    with open(f"{tmp_dir}/good", "w") as f:
        f.write("('a,b','c')\n(\"it's\", u'q')\n(1, 2)\n\n")
    got = [tuple(r) for r in readers.read_edges(spark, f"{tmp_dir}/good", "string").collect()]
    assert got == [("a,b", "c"), ("it's", "q"), ("1", "2")]
    with open(f"{tmp_dir}/bad", "w") as f:
        f.write("(1, 2)\nnonsense\n")
    with pytest.raises(Exception, match="not an edge"):
        readers.read_edges(spark, f"{tmp_dir}/bad").collect()


def test_ragged_rows_and_null_columns(spark, tmp_dir):
    with open(f"{tmp_dir}/dense", "w") as f:
        f.write("1,2,3\n4,5,6,7\n")
    with pytest.raises(Exception, match="expected 3 values"):
        readers.read_dense(spark, f"{tmp_dir}/dense").collect()
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert writers.tuple_lines(df).first().value == "(1, None)"


def test_sparse_lines_keep_escapes_and_float_labels(spark, tmp_dir):
    with open(f"{tmp_dir}/good", "w") as f:
        f.write("({u'caf\\xe9': 1.0, 'a\"b': -2e-1, \"it's\": 3}, -1.0)\n({}, +1)\n\n({'x, y: 1': .5}, 1)\n")
    data, rows = readers.read_sparse(spark, f"{tmp_dir}/good")
    assert sorted((r.label, r.feature, r.value) for r in data.collect()) == [
        (-1, 'a"b', -0.2), (-1, "caf\u00e9", 1.0), (-1, "it's", 3.0), (1, "x, y: 1", 0.5)]
    assert sorted(r.label for r in rows.collect()) == [-1, 1, 1]
    assert data.select("row_id").distinct().join(rows, "row_id").count() == 2
    for k, bad in enumerate(["({'a': b}, 1)", "({'a': 1.0 'b': 2.0}, 1)", "nonsense", "({'a': 1.0}, 2)", "({'a': 1.0,}, 1)"]):
        with open(f"{tmp_dir}/bad{k}", "w") as f:
            f.write(bad + "\n")
        with pytest.raises(Exception, match="not a sparse example|label must be"):
            readers.read_sparse(spark, f"{tmp_dir}/bad{k}")[0].collect()


def test_corpus_keeps_every_file(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/c/sub")
    for name, text in {"a b.txt": "one", "sub/c.txt": "two\nlines", "empty": ""}.items():
        with open(f"{tmp_dir}/c/{name}", "w") as f:
            f.write(text)
    got = {r.doc_id.rsplit("/", 1)[1]: r.text for r in readers.read_corpus(spark, f"{tmp_dir}/c").collect()}
    assert got == {"a b.txt": "one", "c.txt": "two\nlines", "empty": ""}


def test_corpus_is_written_by_tasks_without_a_commit(spark, tmp_dir):
    import os

    rows = [(7, "a\nb"), (8, ""), (9, None), (None, "no id"), (-3, "x"), (7, "a\nb"), (10, " tail\x00\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert writers.write_corpus(docs, f"{tmp_dir}/c") == 6
    names = [os.path.join(d, f) for d, _, files in os.walk(f"{tmp_dir}/c") for f in files]
    assert len(names) == 6 and all(f.endswith(".txt") for f in names)  # no commit marker, nothing half written
    got = {r.doc_id.rsplit("/", 1)[1]: r.text for r in readers.read_corpus(spark, f"{tmp_dir}/c").collect()}
    assert got == {"7.txt": "a\nb\x00a\nb", "8.txt": "", "9.txt": "", "null.txt": "no id", "-3.txt": "x", "10.txt": " tail\x00\n"}
    assert writers.write_corpus(docs.limit(0), f"{tmp_dir}/none") == 0
    assert readers.read_corpus(spark, f"{tmp_dir}/none").count() == 0


def test_other_lines_are_refused(spark, tmp_dir):
    with open(f"{tmp_dir}/r", "w") as f:
        f.write("1,2,3.5\n1,x,2\n")
    with pytest.raises(Exception, match="not a rating"):
        readers.read_ratings(spark, f"{tmp_dir}/r").collect()
    with open(f"{tmp_dir}/s", "w") as f:
        f.write("(u'a', 1)\nb 2\n")
    with pytest.raises(Exception, match="not a score"):
        readers.read_scores(spark, f"{tmp_dir}/s").collect()


def test_line_search_goes_on_past_sixty_trials():
    step, k = linear.backtracking(1.0, 1.0, lambda t: 1.0 - t if t < 0.6 ** 70 else 2.0)
    assert k > 60 and step == 0.6 ** k


def test_verdict_rules_the_mappings(spark):
    colors = graph.joint_colors(path_graph(spark, 3), path_graph(spark, 4))
    assert graph.node_mapping(colors).collect() == [] and graph.candidate_mapping(colors).collect() == []
    assert graph.compare_graphs(path_graph(spark, 3), path_graph(spark, 4)).first().verdict == "not isomorphic"
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 1)], "src long, dst long")
    same = graph.joint_colors(ring, ring)
    assert graph.compare_colorings(same).first().verdict == "maybe isomorphic"
    assert graph.candidate_mapping(same).count() == 8


def test_cosine_of_one_pair(spark):
    from tessera.operators import text

    def vector(*rows):
        return spark.createDataFrame(list(rows), "term string, score double")

    a, b = vector(("x", 3.0), ("y", 4.0)), vector(("x", 3.0), ("z", 4.0))
    assert abs(text.cosine_similarity(a, b).first().cosine - 9 / 25) < 1e-12
    assert text.cosine_similarity(a, vector(("q", 1.0))).first().cosine == 0.0
    assert text.cosine_similarity(a, vector(("x", 0.0))).first().cosine is None
    assert text.cosine_similarity(a, vector()).first().cosine is None


def test_settings_of_the_caller_stay(spark):
    from tessera.session import apply_recommended

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_recommended(other)
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_python_escapes_are_decoded_in_order(spark):
    body = r"a\\x41 \x41\'\" é😀 \U0001f600\n\t\\"
    lines = spark.createDataFrame([(f"(u'{body}', 1)",)], "value string")
    assert readers.parse_scores(lines).first().term == "a\\x41 A'\" é\U0001f600 \U0001f600\n\t\\"


def test_written_text_comes_back(spark):
    texts = ["it's", 'say "x"', "back\\slash \\n", "two\nlines\r\n", "", "é\U0001f600", "', 3)"]
    df = spark.createDataFrame([(t, float(k)) for k, t in enumerate(texts)], "term string, score double")
    lines = writers.tuple_lines(df)
    assert all("\n" not in r.value and "\r" not in r.value for r in lines.collect())
    assert sorted(map(tuple, readers.parse_scores(lines).collect())) == sorted((t, float(k)) for k, t in enumerate(texts))


def test_bucketed_table_has_a_file_per_bucket_and_is_dropped(spark):
    from tessera.plans import joins
    from tessera.plans.iterate import Materializer

    fact = spark.range(0, 5000, 1, 7).select((F.col("id") % 97).alias("k"), "id")
    split = joins.SkewSplitTable(fact, ["k"], Materializer(spark), 5000)
    assert len(spark.table(split.table).inputFiles()) <= split.partitions
    per_key = spark.range(97).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert split.join(per_key).agg(F.sum(F.col("v") - F.col("k"))).first()[0] == 0
    split.close()
    assert not spark.catalog.tableExists(split.table)
