"""Companies derived from the star-schema tables by rule: three sources, and the links that are true."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYLLABLES = "ba de fi go lu ka me ni po ru sa te vi zo xa ye qu".split()
STREETS = ["Oak Street", "Main Road", "Mill Lane", "Park Avenue", "rue Mercier", "Hill Drive", "boulevard Leroy", "Station Square"]
CITIES = "Dalton Mervale Norwick Ostend Pineford Quimby Rosny Selby Tarnow Ulster Vernon Wexley".split()
SUFFIXES = "Inc Ltd LLC SARL Group Services".split()


def _pick(words: list[str], i: Column) -> Column:
    return F.element_at(F.split(F.lit(",".join(words)), ","), (i + 1).cast("int"))


def _word(k: Column) -> Column:
    m = (k * 7919) % 83521
    return F.concat(*[_pick(SYLLABLES, F.floor(m / d) % 17) for d in (1, 17, 289, 4913)])


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("customer", "part", "nation", "region")}
    k = F.col("k")
    rows = (
        t["customer"].join(t["part"], F.col("c_custkey") == F.col("p_partkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("k"), F.col("p_name").alias("p"), F.col("r_name").alias("country"))
    )
    return rows.withColumns({
        "w": _word(k), "w1": _word(k + 1), "num": (k % 997 + 1).cast("string"), "num1": (k % 997 + 2).cast("string"),
        "street": _pick(STREETS, k % 8), "city": _pick(CITIES, k % 12), "suffix": _pick(SUFFIXES, k % 6),
    })


def _name(v: Column) -> Column:
    join = lambda *c: F.concat_ws(" ", *c)
    short_w = F.concat(F.substring("w", 1, 2), F.expr("substring(w, 4)"))
    return (
        F.when(v == 0, F.upper(join("w", "p", "suffix"))).when(v == 1, join("w", "p")).when(v == 2, join("p", "w", "suffix"))
        .when(v == 3, join(short_w, "p", "suffix")).when(v == 4, join(F.replace(join("w", "p"), F.lit("e"), F.lit("é")), "suffix"))
        .otherwise(F.concat(join("w", "p"), F.lit(".com")))
    )


def _address(num: Column, a: Column) -> Column:
    street = F.when(a == 2, F.replace(F.replace("street", F.lit("Street"), F.lit("St")), F.lit("Road"), F.lit("Rd"))).otherwise(F.col("street"))
    full = (
        F.when(a == 3, "").when(a == 4, F.concat(num, F.lit("b "), street, F.lit(" "), F.col("city")))
        .otherwise(F.concat(F.when(a == 1, "00").otherwise(""), num, F.lit(" "), street, F.lit(", "), F.col("city")))
    )
    return full


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference records and targets: entity_id, business_name, business_address, country, ordinal."""
    rows, k = base(spark, sf_dir), F.col("k")

    def shape(df: DataFrame, prefix: str, name: Column, address: Column) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), k.cast("string")).alias("entity_id"), name.alias("business_name"), address.alias("business_address"), "country", k.alias("ordinal"))

    num, gone = F.col("num"), k % 23 == 0
    s1 = shape(rows, "S1-", F.concat_ws(" ", "w", "p", "suffix"), _address(num, F.lit(0)))
    s2 = shape(rows.filter(k % 7 != 0), "S2-", _name(k % 6), F.when(gone, "null").otherwise(_address(num, k % 5)))
    s3 = shape(rows.filter(k % 5 != 0), "S3-", _name((k + 3) % 6), F.when(gone, "null").otherwise(_address(num, (k + 2) % 5)))
    near = shape(rows.filter(k % 10 == 3), "S2-X", F.concat_ws(" ", "w1", "p", "suffix"), _address(F.col("num1"), F.lit(0)))
    return s1, s2.union(near).union(s3)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True links (s1_id, tid)."""
    k = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))
    tid = lambda s, m: F.when(F.col("k") % m != 0, F.concat(F.lit(s), F.col("k").cast("string")))
    out = k.select(F.concat(F.lit("S1-"), F.col("k").cast("string")).alias("s1_id"), F.explode(F.array(tid("S2-", 7), tid("S3-", 5))).alias("tid"))
    return out.filter("tid is not null")
