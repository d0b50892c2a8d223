import gzip
import json

import pytest
from pyspark.sql import functions as F

from lymphoframe.plans.queries import views
from lymphoframe.plans.sinks import per_key_tsv, wide_lengths, wide_matrix, write_length_reports, write_parquet, write_reports, write_tsv
from lymphoframe.sources import airr
from lymphoframe.streaming.usage import usage_now, usage_stream


def test_rearrangement_files(spark, tmp_path):
    head = "sequence_id\trepertoire_id\tproductive\tduplicate_count\tv_call\textra\n"
    (tmp_path / "r1.airr.tsv").write_text(head + "s1\tr1\tT\t3\tA*01\tx\ns2\tr1\t\t\t\t7\n")
    with gzip.open(tmp_path / "r2.airr.tsv.gz", "wt") as f:
        f.write(head + "s3\t\tF\t1\tB*01\ty\n")
    out = airr.read_rearrangements(spark, [str(tmp_path / "r1.airr.tsv"), str(tmp_path / "r2.airr.tsv.gz")])
    got = {r.sequence_id: (r.repertoire_id, r.productive, r.duplicate_count, r.v_call, r.extra, r.junction_aa) for r in out.collect()}
    assert got == {"s1": ("r1", True, 3, "A*01", "x", None), "s2": ("r1", None, None, "", "7", None), "s3": (None, False, 1, "B*01", "y", None)}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        airr.read_rearrangements(spark, str(tmp_path / "none.tsv"))
    assert airr.rearrangement_paths(["a"], "d", "st") == ["d/a.st.airr.tsv"] and airr.rearrangement_paths(["a"], "d", files=["x.tsv"]) == ["d/x.tsv"]


def test_dimension_files(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"GermlineSet": [{"allele_descriptions": [{"label": "A*01", "locus": "IGH", "sequence_type": "V", "gene_designation": "1", "subgroup_designation": None}, {"label": "A*01", "locus": "IGH", "sequence_type": "V", "gene_designation": "2", "subgroup_designation": "3"}]}]}))
    assert [tuple(r) for r in airr.read_germline(spark, str(tmp_path / "g.json")).collect()] == [("A*01", "IGH", "V", "2", "3")]
    (tmp_path / "m.json").write_text(json.dumps({"Repertoire": [{"repertoire_id": "r1"}, {"repertoire_id": "r2"}]}))
    assert airr.read_repertoires(spark, str(tmp_path / "m.json")).count() == 2
    leaf = {"op": "=", "content": {"field": "locus", "value": "IGH"}}
    (tmp_path / "gr.json").write_text(json.dumps({"RepertoireGroup": [{"repertoire_group_id": "g", "repertoires": [{"repertoire_id": "r1"}, {"repertoire_id": "r2"}], "filter": {"Rearrangement": leaf}}, {"repertoire_group_id": "h", "repertoires": [{"repertoire_id": "r1"}]}]}))
    assert airr.read_groups(spark, str(tmp_path / "gr.json")).count() == 3
    assert airr.read_group_filters(spark, str(tmp_path / "gr.json")) == {"g": leaf}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, [1, 2]), ("a", 1, [3])], "k string, n int, x array<int>")
    write_tsv(df, str(tmp_path / "t"), ["k"])
    text = next((tmp_path / "t").glob("part-*")).read_text().splitlines()
    assert text[0] == "k\tn\tx" and text[1].startswith("a\t1\t")
    write_parquet(df, str(tmp_path / "p"), "k")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    per_key_tsv(df.select("k", "n"), str(tmp_path / "s"), "k")
    assert (tmp_path / "s" / "k=a").is_dir()
    paths = write_reports({"one": df, "two": df.withColumnRenamed("k", "repertoire_id")}, str(tmp_path / "r"), "stage")
    assert spark.read.parquet(paths[1]).count() == 2 and (tmp_path / "r" / "two.stage" / "repertoire_id=a").is_dir()
    write_reports({"one": df}, str(tmp_path / "q"), form="tsv")
    lengths = spark.createDataFrame([("r", False, 0, 0.0), ("r", False, 1, 2.0)], "repertoire_id string, productive boolean, length long, count double")
    wide = wide_lengths(lengths, 2).first()
    assert wide["2"] is None and wide["1"] == 2.0 and (wide["total"], wide["avg"]) == (2.0, 1.0)
    grouped = lengths.select(F.lit("g").alias("repertoire_group_id"), "*", (F.col("count") / 2).alias("relative"))
    paths = write_length_reports({"length_aa_group_repertoires": grouped}, str(tmp_path / "w"), 2)
    assert [next(tmp_path.joinpath("w", x.rsplit("/", 1)[1]).glob("part-*")).read_text().splitlines()[1] for x in paths] == ["g\tr\tfalse\t2.0\t1.0\t0.0\t2.0\t", "g\tr\tfalse\t1.0\t1.0\t0.0\t1.0\t"]
    pairs = spark.createDataFrame([("aa", "x", "y", 3)], "level string, repertoire_id_a string, repertoire_id_b string, n long")
    assert wide_matrix(pairs, "n", ["x", "y"]).first()["y"] == 3


def test_input_order_is_the_reference_order(spark, tmp_path):
    """Rows in the order of the listed files, whatever their sizes and headers; clone ids follow it."""
    from lymphoframe.operators import clones

    head = "sequence_id\trepertoire_id\tlocus\tproductive\tduplicate_count\tv_call\tj_call\tjunction_aa\n"
    row = lambda k, n: f"s{k}\tr\tTRB\tT\t{n}\tV{k % 7}\tJ1\tCAS{'ACDEFGHIKL'[k % 10]}\n"
    (tmp_path / "b small.tsv").write_text(head + row(3, 9))
    (tmp_path / "a+large.tsv").write_text(head + "".join(row(k, k) for k in range(5000)))
    (tmp_path / "other.tsv").write_text(head.replace("locus", "more\tlocus").replace("sequence_id", "\ufeffsequence_id") + "s9999\tr\tx\tTRB\tT\t77\tV3\tJ1\tCASE\n")
    (tmp_path / "empty.tsv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        read = airr.read_rearrangements(spark, [str(tmp_path / f) for f in ("b small.tsv", "empty.tsv", "a+large.tsv", "other.tsv")])
        assert read.rdd.getNumPartitions() > 4
        ids = [r.sequence_id for r in read.orderBy("ord").collect()]
        assert ids == ["s3", *[f"s{k}" for k in range(5000)], "s9999"]
        found = {(r.v, r.junction_aa): r for r in clones.clones(read, "allele", "ord").collect()}
        first = found["V3", "CASE"]  # the small file's clone comes first; its weight is the last row's, of the last file
        assert first.clone_id == 1 and first.duplicate_count == 77 and found["V0", "CASA"].clone_id == 2
        assert sorted(r.clone_id for r in found.values()) == list(range(1, 71))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert airr.read_rearrangements(spark, str(tmp_path / "empty.tsv")).count() == 0


def test_a_report_of_many_parts_is_in_order(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("n"), F.lit("x").alias("k"))
    write_tsv(df, str(tmp_path / "t"), ["n"], parts=5)
    parts = sorted(tmp_path.joinpath("t").glob("part-*"))
    lines = [x.split("\t")[0] for p in parts for x in p.read_text().splitlines()]
    assert len(parts) == 5 and lines.count("n") == 5 and [int(x) for x in lines if x != "n"] == list(range(3000))


def test_wide_reports_come_with_a_run(spark, tmp_path):
    from lymphoframe.plans.spec import Context, run

    rows = spark.createDataFrame([(f"s{k}", f"r{k % 2}", True, 1, "CAS", "TGT") for k in range(4)], "sequence_id string, repertoire_id string, productive boolean, duplicate_count long, junction_aa string, junction string")
    rows = rows.selectExpr("*", "'TRB' locus", "'' v_call", "'' d_call", "'' j_call", "'' c_call", "3L junction_length", "3L junction_aa_length")
    members = spark.createDataFrame([("g", "r0"), ("g", "r1")], "repertoire_group_id string, repertoire_id string")
    germline = spark.createDataFrame([], "label string, locus string, sequence_type string, gene_designation string, subgroup_designation string")
    units = spark.createDataFrame([("r0",), ("r1",), ("r2",)], "repertoire_id string")
    out = run(Context(rows, germline, members, repertoires=units), [{"type": "CDR3", "operations": ["length", "distribution", "shared", "compare"], "levels": ["aa"]}])
    paths = {p.rsplit("/", 1)[1]: p for p in write_reports(out, str(tmp_path / "all"), form="tsv")}
    read = lambda name: spark.read.csv(paths[name], sep="\t", header=True)
    assert {(r.repertoire_id_a, r.r0, r.r1, r.r2) for r in read("share_matrix_shared_wide").collect()} == {("r0", "1", "1", "0"), ("r1", "1", "1", "0"), ("r2", "0", "0", "0")}
    assert {r.C for r in read("distribution_aa_wide").where("position = 0").collect()} == {"2"} and "Y" in read("distribution_aa_groups_wide").columns
    assert read("length_aa_group_repertoires_count").where("productive = 'true'").first()["3"] == "2.0"


def test_usage_stream_equals_batch(spark, sf, tmp_path):
    rows, germline = views(spark, sf, "rearrangements", "germline")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = usage_stream(stream, germline, str(tmp_path / "now"), str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    from lymphoframe.functions.calls import resolve
    from lymphoframe.operators.segments import usage

    keys = ["repertoire_id", "field", "level", "mode", "productive", "name"]
    key = lambda df: {tuple(r[k] for k in keys): round(r.sequence_count, 6) for r in df.select(*keys, F.col("sequence_count")).collect()}
    assert key(usage_now(spark, str(tmp_path / "now"))) == key(usage(resolve(rows, germline)))
