"""Sparse block algebra; suppliers by parts serve as incidence matrices of small whole numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.operators import blocks, scatter
from tessella.plans.tables import near, table

_A = "select l_suppkey as i, l_partkey % 40 as j, cast(sum(cast(l_linenumber as bigint)) as bigint) as val from lineitem where l_returnflag = 'R' group by 1, 2"
_V = "select s_suppkey as i, s_nationkey + 1 as val from supplier"


def _a(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 40).alias("j")).agg(F.sum(F.col("l_linenumber").cast("long")).alias("val"))


def _v(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("i"), (F.col("s_nationkey") + 1).alias("val"))


_GRAM = f"select a.j as i, b.j as j, cast(sum(a.val * b.val) as bigint) as val from ({_A}) a join ({_A}) b on a.i = b.i group by 1, 2"


@query("block_ata", _GRAM)
def block_ata(spark, d):
    return blocks.gram(_a(spark, d))


@query("block_atb", f"select a.j as i, b.j as j, cast(sum(a.val * b.val) as bigint) as val from ({_A}) a join (select i, j // 4 as j, val from ({_A})) b on a.i = b.i group by 1, 2")
def block_atb(spark, d):
    b = _a(spark, d).withColumn("j", F.floor(F.col("j") / 4))
    return blocks.transposed_product(_a(spark, d), b)


@query("block_atv", f"select a.j as i, cast(sum(a.val * v.val) as bigint) as val from ({_A}) a join ({_V}) v on a.i = v.i group by 1")
def block_atv(spark, d):
    return blocks.transposed_vector(_a(spark, d), _v(spark, d))


@query("block_product", f"select a.j as i, b.j as j, cast(sum(a.val * b.val) as bigint) as val from (select i, j, val from ({_A})) a join (select i, j % 20 as j, val from ({_A})) b on a.i = b.i group by 1, 2")
def block_product(spark, d):
    return blocks.product(blocks.transpose(_a(spark, d)), _a(spark, d).withColumn("j", F.col("j") % 20))


@query("block_damping", f"select i, j, round(val + case when i = j then 0.1 + 0.01 * val else 0 end, 4) + 0.0 as val from ({_GRAM})")
def block_damping(spark, d):
    g = blocks.gram(_a(spark, d)).withColumn("val", F.col("val").cast("double"))
    return blocks.damped(g, 0.01, 0.1).select("i", "j", near(F.col("val"), 4).alias("val"))


@query(
    "schur_diag",
    f"""with a as ({_A}), h as ({_GRAM}), c as (select i as k, sum(val) + 1 as c from a group by 1),
    s as (select x.j as i, y.j as j, sum(x.val * y.val / c.c) as e from a x join a y on x.i = y.i join c on c.k = x.i group by 1, 2)
    select i, j, round(coalesce(h.val, 0) - coalesce(s.e, 0), 4) + 0.0 as val from h full join s using (i, j)""",
)
def schur_diag(spark, d):
    a = _a(spark, d)
    h = blocks.gram(a).withColumn("val", F.col("val").cast("double"))
    e = blocks.transpose(a)
    c = a.groupBy("i").agg((F.sum("val") + 1).alias("val")).select("i", F.col("i").alias("j"), "val")
    return blocks.schur(h, e, c).select("i", "j", near(F.col("val"), 4).alias("val"))


@query("block_ravel", "select s_nationkey as grp, s_suppkey as block, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as dense, (row_number() over (partition by s_nationkey order by s_suppkey) - 1) * 6 as row_ from supplier")
def block_ravel(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("grp"), F.col("s_suppkey").alias("block"))
    return scatter.ravelled(s, ["grp"], "block", 6).select("grp", "block", F.col("dense").cast("long").alias("dense"), F.col("row").cast("long").alias("row_"))


@query("diagonal_inverse", f"select i, j, round(1.0 / val, 8) + 0.0 as val from ({_GRAM}) where i = j")
def diagonal_inverse(spark, d):
    return blocks.diagonal_inverse(blocks.gram(_a(spark, d))).select("i", "j", near(F.col("val"), 8).alias("val"))
