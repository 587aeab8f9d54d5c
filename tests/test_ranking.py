"""Cut-offs by selection, against sorting in Python."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samplecraft.plans import ranking

KINDS = {
    "double": lambda r: r.choice([None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, r.random(), r.gauss(0, 1e9)]),
    "float": lambda r: r.choice([None, float("nan"), 0.5, float(r.randrange(8))]),
    "long": lambda r: r.choice([None, r.randrange(5), (1 << 62) + r.randrange(3), -(1 << 62)]),
    "boolean": lambda r: r.choice([None, True, False]),
    "string": lambda r: r.choice([None, "", "é", "same prefix " + str(r.randrange(9)), "\U0001f600x", str(r.randrange(1000)), "a" * 6, "a" * 7]),
    "date": lambda r: r.choice([None, datetime.date(1960, 1, 1) + datetime.timedelta(r.randrange(40000))]),
    "timestamp": lambda r: r.choice([None, datetime.datetime(1960, 1, 1) + datetime.timedelta(seconds=r.randrange(10**9), microseconds=r.randrange(10**6))]),
    "decimal(30,3)": lambda r: r.choice([None, Decimal(r.randrange(100)) / 8, Decimal(10) ** 20]),
    "struct<a:int,b:string>": lambda r: r.choice([None, (r.randrange(3), "x"), (None, r.choice("ab"))]),
}


def numbered(df, keys, reverse):
    """Every row's rank by Spark's own sort: equal keys have one rank."""
    from pyspark.sql import Window

    order = ranking.directed(keys, reverse)
    return df.withColumn("rank", F.rank().over(Window.orderBy(*order)))


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("reverse", [False, True])
def test_cuts_of_every_type(spark, monkeypatch, kind, reverse):
    monkeypatch.setattr(ranking, "TOPK_ROWS", 1)
    rng = random.Random(7)
    rows = [(KINDS[kind](rng), rng.randrange(30)) for _ in range(400)]
    df = spark.createDataFrame(rows, f"k {kind}, id long").repartition(5).withColumn("row", F.monotonically_increasing_id())
    df = spark.createDataFrame(df.collect(), df.schema).repartition(5)
    keys = [F.col("k"), F.col("id")]
    rank = {r.row: r["rank"] for r in numbered(df, keys, reverse).collect()}
    for topk, cores, n in [(1000, 2, 333), (7, 1, 200), (5, 16, 400)]:
        monkeypatch.setattr(ranking, "TOPK_KEYS", topk)
        monkeypatch.setattr(ranking, "CORES", cores)
        first = [r.row for r in ranking.first_rows(df, keys, n, reverse).collect()]
        after = [r.row for r in ranking.after_rows(df, keys, n, reverse).collect()]
        assert len(first) == len(set(first)) == min(n, 400) and len(after) == len(set(after)) == max(400 - n, 0)
        if first and after:  # ties may fall on either side, nothing else
            assert max(rank[r] for r in first) <= min(rank[r] for r in after)


def test_only_rows_around_the_cut_are_ranked(spark, monkeypatch):
    """Of 50,000 distinct keys the sketches leave a few hundredths to be ranked."""
    seen = []
    ranked = ranking.ranked
    monkeypatch.setattr(ranking, "ranked", lambda df, *args: seen.append(df.count()) or ranked(df, *args))
    monkeypatch.setattr(ranking, "TOPK_KEYS", 100)
    for key in (F.md5(F.col("id").cast("string")), F.hash("id")):
        df = spark.range(50_000).select(key.alias("k"), "id")
        keys = [F.col("k"), F.col("id")]
        got = [tuple(r) for r in ranking.first_rows(df, keys, 21_234).collect()]
        assert sorted(got) == sorted(map(tuple, df.collect()))[:21_234]
    assert len(seen) == 2 and max(seen) < 1500


def test_one_value_for_all(spark, monkeypatch):
    """A sort value that all rows share: the sketches bound nothing, the result is exact."""
    monkeypatch.setattr(ranking, "TOPK_KEYS", 10)
    monkeypatch.setattr(ranking, "TOPK_ROWS", 10)
    df = spark.range(3000).select(F.lit("same").alias("k"), "id")
    got = [r.id for r in ranking.first_rows(df, [F.col("k"), F.col("id")], 1234).collect()]
    assert sorted(got) == list(range(1234))
