"""Kinds of values: the rare ones, and how the pass that counts them is compiled."""

from ordermill.sources.column_types import KINDS, kind_counts, value_kind

WANTED = {
    "12": "integer", "-9223372036854775808": "integer", "0000000000000000000000012": "integer",
    "18446744073709551615": "wide_integer", "18446744073709551616": "huge_integer",
    "-9223372036854775809": "huge_integer", "9" * 60: "huge_integer",
    "1.5": "decimal", "1e5": "decimal", "12345.670000000000002": "decimal", "1e999": "text",
    "1E400": "text", "9" * 310 + ".5": "text", "inf": "decimal", "-Infinity": "decimal",
    "1e": "text", "e1": "text", "true": "boolean", "nan": "missing", "": "missing", "x1": "text",
}


def test_every_kind(spark):
    texts = spark.createDataFrame([(t,) for t in [*WANTED, None]], "v string")
    found = {r["v"]: KINDS[r["kind"]] for r in texts.select("v", value_kind("v").alias("kind")).collect()}
    assert found == {**WANTED, None: "missing"}


def test_kinds_are_not_compiled_into_one_method_with_the_pass(spark, tmp_path):
    """A method too long for the JVM's compiler is interpreted. Projections alone are split."""
    columns = [f"k{i}" for i in range(9)]
    spark.createDataFrame([("1",) * 9], ", ".join(f"{c} string" for c in columns)).write.parquet(
        str(tmp_path / "texts"))
    counts = kind_counts(spark.read.parquet(str(tmp_path / "texts")), columns)
    assert {r["integer"] for r in counts.collect()} == {1}
    plan = counts._jdf.queryExecution().executedPlan().toString().splitlines()
    kinds = [line for line in plan if "Project" in line and "RLIKE" in line]
    assert kinds and all("*(" not in line.split("Project")[0] for line in kinds)
