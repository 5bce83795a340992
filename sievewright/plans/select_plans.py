"""Queries that rank, select and split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import select, split
from ..sources.tables import table

ABCD = ("A", "B", "C", "D")


def best_per_seed(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem")
    order = [F.asc(F.col("l_returnflag") == "N"), F.desc("l_extendedprice"), F.asc("l_linenumber")]
    return select.keep_first(items, ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


def near_tie_pick(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return select.near_tie(items, ["l_orderkey"], "l_extendedprice", "l_quantity", 2000.0, [F.asc("l_linenumber")])


NEAR_TIE = """WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, row_number() OVER w AS r, lead(l_extendedprice) OVER w AS s, lead(l_quantity) OVER w AS q
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity, l_linenumber)),
k AS (SELECT *, max(CASE WHEN r = 1 THEN CASE WHEN coalesce(l_extendedprice - s <= 2000 AND q < l_quantity, false) THEN 2 ELSE 1 END END) OVER (PARTITION BY l_orderkey) AS want FROM r)
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM k WHERE r = want"""


def quota_by_label(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return select.quota(parts, "p_brand", 20, [F.desc("p_size"), F.asc("p_partkey")])


def fallback_quota(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_type", "p_size")
    return select.fallback_quota(parts, "p_type", 60, 10, [F.desc("p_size"), F.asc("p_partkey")])


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return select.round_robin(orders, "o_orderpriority", [F.asc("o_orderkey")])


def even_spaced_interior(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return select.even_spaced(orders, ["o_orderpriority"], [F.asc("o_orderkey")], 7, True)


def even_spaced_endpoints(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return select.even_spaced(orders, ["o_orderpriority"], [F.asc("o_orderkey")], 7, False)


def _even(at: str) -> str:
    return f"""WITH n AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority FROM n WHERE n <= 7 OR list_contains(list_transform(range(0, 7), lambda s: CAST(round_even({at}, 0) AS BIGINT)), i)"""


def label_schedule(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    return select.label_schedule(parts, ["p_brand"], [F.asc("p_partkey")], ABCD)


def apportion_quota(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return select.apportion(counts, "c_mktsegment", "n", 100)


APPORTION = """WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT *, sum(n) OVER () AS t FROM c),
f AS (SELECT *, CAST(n * 100 // t AS BIGINT) AS f, (n * 100) % t AS r FROM t),
k AS (SELECT *, row_number() OVER (ORDER BY r DESC, c_mktsegment DESC) AS place, 100 - sum(f) OVER () AS spare FROM f)
SELECT c_mktsegment, n, CAST(f + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM k"""


def family_split(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return split.family_split(orders, "o_orderpriority", "o_custkey", F.col("o_orderkey"))


FAMILY_SPLIT = """WITH f AS (SELECT o_orderpriority, o_custkey, min(o_orderkey) AS f FROM orders GROUP BY 1, 2),
p AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY f, o_custkey) AS i FROM f),
s AS (SELECT *, CASE WHEN n >= 3 THEN CASE WHEN i <= n - 2 THEN 'train' WHEN i = n - 1 THEN 'dev' ELSE 'test' END WHEN i = 1 THEN 'train' ELSE 'test' END AS split FROM p),
k AS (SELECT o_orderpriority, min(o_orderkey) AS k FROM orders GROUP BY 1),
l AS (SELECT o_custkey, split FROM s JOIN k USING (o_orderpriority) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY k DESC, o_orderpriority DESC) = 1)
SELECT o_orderkey, o_custkey, o_orderpriority, split FROM orders JOIN l USING (o_custkey)"""


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return sizes.withColumn("eval_rows", split.eval_counts(F.col("n")))


def _rank_split(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return select.top_k(orders, ["o_custkey"], [F.asc("o_orderkey")], 1 << 40).join(split_counts(spark, d), "o_custkey")


def rank_split(spark: SparkSession, d: str) -> DataFrame:
    return _rank_split(spark, d).select("o_orderkey", "o_custkey", split.split_by_rank(F.col("rank"), F.col("n")).alias("split"))


_LADDER = "CASE WHEN n >= 80 THEN 16 WHEN n >= 64 THEN 12 WHEN n >= 40 THEN 8 WHEN n >= 20 THEN 4 WHEN n >= 10 THEN 2 ELSE 0 END"
RANK_SPLIT = f"""WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders), h AS (SELECT *, {_LADDER} AS h FROM r)
SELECT o_orderkey, o_custkey, CASE WHEN r <= n - h THEN 'train' WHEN r <= n - h + h // 2 THEN 'dev' ELSE 'test' END AS split FROM h"""


def split_lock(spark: SparkSession, d: str) -> DataFrame:
    return split.lock_status(table(spark, d, "orders"), "o_custkey", "o_orderstatus")


SPLIT_LOCK = """SELECT o_custkey, count(*) AS row_count, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS splits, CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'cross_split' ELSE 'ok' END AS lock_status FROM orders GROUP BY o_custkey"""


def split_lock_histogram(spark: SparkSession, d: str) -> DataFrame:
    return split_lock(spark, d).groupBy("lock_status").agg(F.count("*").alias("families"), F.sum("row_count").alias("row_count"))


def split_disposition(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return split.disposition(orders, "o_custkey", "o_orderstatus", {"F": 2, "P": 1, "O": 0})


DISPOSITION = """WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS r FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN r = max(r) OVER (PARTITION BY o_custkey) THEN 'keep' ELSE 'quarantine' END AS disposition FROM r"""


def row_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return select.ordinal(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


def forward_fill_role(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    asked = F.when(F.col("role") == "user", F.col("turn"))
    return select.carry_forward(turns, ["conv_id"], [F.asc("turn")], asked, "last_user_turn").select("conv_id", "turn", "role", "last_user_turn")


def choice_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The four first values of each vector as choice scores: ranks, ties in label order."""
    rows = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: F.round(x.cast("double"), 6)).alias("scores"))
    return select.rank_choices(rows, ["vec_id"], F.col("scores"), ABCD)


CHOICE_RANKS = """WITH s AS (SELECT vec_id, unnest(embedding[1:4]) AS x, unnest(['A', 'B', 'C', 'D']) AS label FROM embeddings), r AS (SELECT vec_id, round(CAST(x AS DOUBLE), 6) AS score, label FROM s)
SELECT vec_id, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rank, label FROM r"""

QUERIES = {
    "best_per_seed": best_per_seed, "near_tie_pick": near_tie_pick, "quota_by_label": quota_by_label, "fallback_quota": fallback_quota, "round_robin": round_robin,
    "even_spaced_interior": even_spaced_interior, "even_spaced_endpoints": even_spaced_endpoints, "label_schedule": label_schedule, "apportion_quota": apportion_quota,
    "family_split": family_split, "split_counts": split_counts, "rank_split": rank_split, "split_lock": split_lock, "split_lock_histogram": split_lock_histogram,
    "split_disposition": split_disposition, "row_ordinals": row_ordinals, "forward_fill_role": forward_fill_role, "choice_ranks": choice_ranks,
}
ORACLE_SQL = {
    "best_per_seed": "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'N', l_extendedprice DESC, l_linenumber) = 1",
    "near_tie_pick": NEAR_TIE,
    "quota_by_label": "SELECT p_partkey, p_brand, p_size, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) <= 20 THEN 'selected' ELSE 'quota_surplus' END AS pool FROM part",
    "fallback_quota": "SELECT p_partkey, p_type, p_size, CASE WHEN row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) <= CASE WHEN count(*) OVER (PARTITION BY p_type) >= 60 THEN 60 ELSE 10 END THEN 'selected' ELSE 'quota_surplus' END AS pool FROM part",
    "round_robin": "SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS turn FROM orders",
    "even_spaced_interior": _even("(s + 1) / 8.0 * (n - 1)"),
    "even_spaced_endpoints": _even("s * (n - 1) / 6.0"),
    "label_schedule": "SELECT p_partkey, p_brand, ['A', 'B', 'C', 'D'][(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) % 4 + 1] AS label FROM part",
    "apportion_quota": APPORTION,
    "family_split": FAMILY_SPLIT,
    "split_counts": f"SELECT o_custkey, n, CAST({_LADDER} AS BIGINT) AS eval_rows FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)",
    "rank_split": RANK_SPLIT,
    "split_lock": SPLIT_LOCK,
    "split_lock_histogram": f"SELECT lock_status, count(*) AS families, CAST(sum(row_count) AS BIGINT) AS row_count FROM ({SPLIT_LOCK}) GROUP BY 1",
    "split_disposition": DISPOSITION,
    "row_ordinals": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS ordinal FROM orders",
    "forward_fill_role": "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user_turn FROM conversations",
    "choice_ranks": CHOICE_RANKS,
}
