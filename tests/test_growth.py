"""What a task gets does not grow with the tables."""

import glob

import pytest
from pyspark.sql import functions as F

from lociframe.operators import sharding as SH
from lociframe.plans import extra as EX
from lociframe.plans import fixtures as FX
from lociframe.plans import inputs as IN
from lociframe.plans import queries as Q
from lociframe.session import INITIAL, INPUT_BYTES, spread_shuffles
from lociframe.sources import blocks as B


@pytest.fixture
def tables(spark, tmp_path):
    n = F.col("id")
    orders = spark.range(400).select(n.alias("o_orderkey"), (n * 7).alias("o_custkey"),
                                     F.when(n % 3 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"))
    line = spark.range(1200).select((n % 400).alias("l_orderkey"), (1 + n / 400).cast("int").alias("l_linenumber"), (n * 31 % 97).alias("l_partkey"),
                                    (n * 17 % 89).alias("l_suppkey"), (n % 50).cast("decimal(15,2)").alias("l_quantity"),
                                    F.element_at(F.array(F.lit("R"), F.lit("A"), F.lit("N")), (1 + n % 3).cast("int")).alias("l_returnflag"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    line.union(line.limit(5)).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_entries_are_dealt_once(spark, tables):
    """DISTINCT and window of a variant's entries share one shuffle."""
    plan = FX._derive(spark, tables, "fx_csq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    dealt = sorted(FX._derive(spark, tables, "fx_csq").collect())
    assert dealt == sorted(FX.fixture(spark, tables, "fx_csq", store=False).collect()) and len(dealt) == 1200


def test_calls_are_dealt_and_written_once(spark, tables):
    """Grouping lineitem into calls and joining them with the sites share one
    shuffle of lineitem, and no copy of fixture rows is stored on the way."""
    before = set(FX._STORED)
    for twins in (False, True):
        got = IN.calls(spark, tables, twins=twins)
        assert set(FX._STORED) == before
        plan = IN._calls(spark, tables, twins)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 + twins
        assert "Exchange hashpartitioning(l_orderkey#" in plan and "l_linenumber" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
        c = FX.fixture(spark, tables, "fx_calls_t" if twins else "fx_calls", store=False)
        want = IN._shaped_calls(c, IN.sites(spark, tables, twins=twins).select("vid", "record", "contig", "position", "alleles"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.count() == c.count() > 1199


def test_shuffles_begin_with_partitions_for_the_input(spark):
    assert spark.conf.get(INITIAL, None) is None
    try:
        spread_shuffles(spark, 300 * INPUT_BYTES)
        assert spark.conf.get(INITIAL) == "300"
        spread_shuffles(spark, 600 * INPUT_BYTES)
        assert spark.conf.get(INITIAL) == "600"
        spread_shuffles(spark, INPUT_BYTES)      # small inputs keep the session's number
        assert spark.conf.get(INITIAL, None) is None
        spark.conf.set(INITIAL, "77")            # a cluster's own number wins
        spread_shuffles(spark, 300 * INPUT_BYTES)
        assert spark.conf.get(INITIAL) == "77"
    finally:
        spark.conf.unset(INITIAL)


def test_block_files_are_written_by_many_tasks(spark, tables):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "8192")
    try:
        rows = Q.QUERIES["vcf_block_read"](spark, tables)
        assert rows.count() == 400 and rows.select("vid").distinct().count() == 400
    finally:
        spark.conf.set(name, before)
    written = IN.stored_path(spark, tables, "vcf-blocks", None).removeprefix("file:")
    assert len(glob.glob(f"{written}/*.vcf.bgz")) > 2


def test_many_small_ranges_share_tasks(spark, tmp_path):
    lines = [f"line {i} of the file" for i in range(2000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    df = B.read_ranges(spark, B.list_files(spark, str(tmp_path / "a.txt")), range_bytes=64)
    assert df.rdd.getNumPartitions() <= B.FEW_TASKS
    got = df.orderBy("record").collect()
    assert [r.value for r in got] == lines and len({r.record for r in got}) == len(lines)


def test_pairs_of_chunks_are_no_table(spark, monkeypatch):
    """Samples alone are dealt, and no task gets the rows of all pairs."""
    monkeypatch.setattr(SH, "PAIR_ROWS", 1000, raising=False)
    monkeypatch.setattr(SH, "PAIR_BLOCK", 7, raising=False)
    names = [f"x{i:03d}" for i in range(200)]
    out = SH.sample_chunk_pairs(spark.createDataFrame([(s,) for s in names + names[:9]], "s string"), 5)
    chunks = [names[i:i + 5] for i in range(0, 200, 5)]
    pairs = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    want = sorted((shard, side, names.index(s) + 1, s) for shard, p in enumerate(pairs) for side, c in enumerate(p) for s in chunks[c])
    assert sorted(map(tuple, out.select("shard", "side", "rn", "s").collect())) == want
    by_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == 7800 and max(by_task) <= 2600


def test_entries_stay_where_their_variant_is(spark, tmp_path):
    """Entries are dealt once, before they multiply, and regrouped there; what is
    looked up by transcript goes without them; sites leave the old CSQ behind."""
    def table(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    entry = lambda g, t: f"GENE{g}|{t}|missense|{t}:c.{g}|"
    site = "contig string, position long, alleles array<string>, vid long, info struct<CSQ: array<string>, AC: int>"
    rows = [("chr1", i // 2, ["A", "C"], i, ([entry(i % 5, f"T{i}"), entry(i % 3, f"T{i + 1}"), entry(1, f"T{i}")], i)) for i in range(60)]
    rows += [("chr1", 70, ["A", "C"], 70, None), ("chr1", 71, ["A", "C"], 71, (None, 1)), (None, 72, ["A", "C"], 72, ([entry(1, "T1")], 1)),
             ("chr1", 73, ["A", "C"], 73, (["no parts", entry(1, ""), entry(1, "T3")], 1))]
    variant = "contig string, position long, alleles array<string>, "
    many = range(3000)
    tables = EX.ExtraTables(
        mpc=table("mpc", variant + "mpc double", [("chr1", i, ["A", "C"], i / 7) for i in many]),
        revel=table("revel", "`#chr` string, grch38_pos string, ref string, alt string, REVEL string", [("1", str(i), "A", "C", f"0.{i}") for i in many]),
        loeuf_v2=table("v2", "transcript string, oe_lof_upper string, oe_lof_upper_bin string", [(f"T{i}", None if i == 3 else f"u{i}", "b") for i in many if i % 4]),
        loeuf_v4=table("v4", "transcript string, `lof.oe_ci.upper` string, `lof.oe_ci.upper_bin_decile` string", [(f"T{i}", f"w{i}", "d") for i in many if i % 3]),
        omim=table("omim", "approvedGeneSymbol string, mimNumber string, inheritance_code string", [("GENE1", "600", "AD")]),
        spliceai=table("sa", variant + "SYMBOL string, SpliceAI string", [("chr1", i, ["A", "C"], "GENE1", f"SpliceAI=C|GENE1|{i}|2|3|4|5|6|7|8") for i in many]))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    results = {}
    try:
        for most in ("6000", "33554432"):
            for k in kept:
                spark.conf.set(k, most)
            sites = spark.createDataFrame(rows, site)
            out, text = EX.annotate_extra(sites, "Format: SYMBOL|Feature|Consequence|HGVSc|HGVSp", tables)
            assert out.columns == ["contig", "position", "alleles", "vid", "info"] and out.schema["info"].dataType.fieldNames() == ["CSQ", "AC", "MPC", "REVEL"]
            plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
            dealt = ["".join(plan[i + 1:i + 2]) for i, x in enumerate(plan) if "Exchange hashpartitioning" in x]
            results[most] = {r.vid: r.info for r in out.collect()}
            assert not [x for x in dealt if "t_Consequence" in x or "csq_pos" in x or "info.CSQ AS CSQ" in x]
            assert len([x for x in dealt if "AS _csq" in x]) == 1
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    few, all_sent = results.values()
    assert few == all_sent and len(few) == 64
    assert few[70] is None and few[71].CSQ is None and few[72].CSQ is None and few[72].MPC is None
    assert few[73].CSQ == "||||" + "|" * 14 + ",GENE1||missense|:c.1||||||600|AD|73|2|3|4|5|6|7|8,GENE1|T3|missense|T3:c.1|||b|||600|AD|73|2|3|4|5|6|7|8"
    assert few[2].CSQ.split(",")[0] == few[3].CSQ.split(",")[0] == "GENE2|T2|missense|T2:c.2||u2|b|w2|d||" + "|" * 8 and len(few[2].CSQ.split(",")) == 6
