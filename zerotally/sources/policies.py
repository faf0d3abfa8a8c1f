"""The policy table, derived from the order, customer and line-item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed

SNAPSHOT = "2001-09-01"
# Customer market segments that play the Auto role.
AUTO_MARKETS = ["AUTOMOBILE", "MACHINERY"]


def order_activity(lineitem: DataFrame) -> DataFrame:
    """One row per order: open returns (target), accepted quantity (history), line count."""
    quantity = F.col("l_quantity")
    open_return = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.coalesce(F.sum(F.when(open_return, quantity)), F.lit(0.0)).cast("int").alias("y"),
        F.floor(F.coalesce(F.sum(F.when(F.col("l_returnflag") == "A", quantity)), F.lit(0.0)) / 3)
        .cast("int").alias("h"),
        F.count(F.lit(1)).cast("int").alias("n"),
    )


def build_policies(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    auto = F.col("c_mktsegment").isin(AUTO_MARKETS)

    def every(n):
        return F.floor(key / n)

    def pick(cond, yes, no):
        return F.when(cond, yes).otherwise(no)

    priority = F.substring("o_orderpriority", 1, 1)
    text = F.lit
    columns = {
        "id": key,
        "12m_call_history": F.coalesce("h", F.lit(0)),
        "acq_method": pick(priority == "5", text("missing"), F.concat(text("method"), priority)),
        "ann_prm_amt": F.col("o_totalprice") / 50,
        "bi_limit_group": pick(auto, F.concat(text("Grp"), (every(81) % 7 + 1).cast("string")),
                               text("NonAuto")),
        "channel": pick(auto | (F.col("c_nationkey") % 3 != 0), text("Retail"), text("Others")),
        "digital_contact_ind": pick(F.col("o_orderstatus") == "P", F.lit(1), F.lit(0)),
        "geo_group": F.element_at(F.array(*map(text, fixed.GEO_LEVELS)), (key % 3 + 1).cast("int")),
        "has_prior_carrier": (cust % 2).cast("int"),
        "home_lot_sq_footage": ((cust * 7919) % 150000).cast("double"),
        "household_group": pick(
            auto,
            pick(every(5) % 10 == 0, text("3autodwellingumb"), text("2autodwelling")),
            pick(every(5) % 4 == 0, text("3other"), text("1dwelling"))),
        "household_policy_counts": F.coalesce("n", F.lit(1)),
        "newest_veh_age": pick(auto, (cust % 31).cast("int"), F.lit(-20)),
        "pay_type_code": F.concat(text("type"), (every(9) % 3 + 1).cast("string")),
        "pol_edeliv_ind": F.when(key % 97 == 0, -2).when(key % 311 == 5, -1)
        .when(F.col("c_acctbal") > 4500, 1).otherwise(0),
        "prdct_sbtyp_grp": F.element_at(F.array(text("A"), text("B"), text("C")), (every(3) % 3 + 1).cast("int")),
        "product_sbtyp": F.concat(text("type"), (every(9) % 3 + 1).cast("string")),
        "telematics_ind": pick(auto, (every(27) % 3 - 1).cast("int"), F.lit(-2)),
        "tenure_at_snapshot": F.floor(
            F.datediff(F.to_date(F.lit(SNAPSHOT)), F.col("o_orderdate").cast("date")) / 4).cast("int"),
        "trm_len_mo": pick(auto | (F.col("c_nationkey") % 5 == 0), F.lit(6), F.lit(12)),
        "call_counts": F.coalesce("y", F.lit(0)),
    }
    # customers first: a segment's filter needs no more than these two, so it comes before the large join
    owned = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    # A fixed number of partitions: joined by size they come to one or two more than there are cores, and most cores then
    # wait in this join and in every read of a table that is written from it.
    owned = owned.repartition(int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    joined = owned.join(order_activity(lineitem), "o_orderkey", "left")
    return joined.select(*[c.alias(name) for name, c in columns.items()])


def policies(spark: SparkSession, folder: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return build_policies(read("orders"), read("customer"), read("lineitem"))
