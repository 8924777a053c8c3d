"""Parent pointers on odd keys, against SQL."""

import random

import duckdb

import __spark_entry__  # noqa: F401
from lectern.operators import family
from lectern.plans.registry import ORACLES, QUERIES

#: (o_orderkey, o_custkey): a customer that 3 divides makes half the key the parent.
FOREST = [
    (0, 3), (1, 3), (2, 4), (4, 3), (5, 3), (8, 6),  # 0 is its own parent, 1 is below it
    (-1, 1), (-3, 3), (-2, 5), (-5, 3), (2**53 + 1, 3), (2**52, 1), (2**52 + 1, 1), (2**63 - 1, 3), (2**62 - 1, 2),
    (None, 3), (21, None), (42, 3), (20, 1), (20, 2), (40, 3), (80, 3), (7, 1), (14, 3), (14, 1), (28, 3),  # 20 and 14 twice
]


def _both(spark, tmp_path, name, rows):
    """Rows of a query and of its SQL over orders (key, customer)."""
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"create view orders as select * from read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    mine = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()]
    return sorted(mine, key=str), sorted(con.execute(ORACLES[name]).fetchall(), key=str)


def test_roots_of_odd_keys(spark, tmp_path):
    mine, sql = _both(spark, tmp_path, "family_roots", FOREST)
    assert mine == sql
    assert not [r for r in mine if r[0] in (0, 1)] and len([r for r in mine if r[0] == 28]) == 4


def test_cycles_of_odd_keys(spark, tmp_path):
    # A customer that 7 doesn't divide makes (7 * key + 3) % 15 the parent. 4 is twice on a cycle; 16 leads into one and is a root too.
    loops = [(1, 1), (10, 1), (13, 1), (4, 1), (4, 2), (2, 1), (3, 7), (0, 1), (16, 1), (16, 7), (5, 1), (8, 1), (14, 1), (11, 1), (20, None)]
    mine, sql = _both(spark, tmp_path / "a", "family_cycles", loops)
    assert mine == sql and mine
    mine, sql = _both(spark, tmp_path / "b", "family_cycles", [*loops[:-1], (None, 1)])
    assert mine == sql == []


def _forest(rng, n):
    """Parents of n nodes: chains, trees, dangling pointers and a few cycles."""
    return {k: rng.choice([None, k - 1, k - 1, k - 1, rng.randrange(n), n + 7]) if k else None for k in range(n)}


def test_rounds_follow_depth(spark):
    rng = random.Random(3)
    for n in (1, 2, 60, 400):
        parents = _forest(rng, n)
        rows, cycles = {}, set()
        for k in parents:
            at, depth = k, 0
            while parents[at] in parents and depth <= n:
                at, depth = parents[at], depth + 1
            rows[k] = (None, None) if depth > n else (at, depth)
            cycles |= {k} if depth > n else set()
        df = spark.createDataFrame(list(parents.items()), "k long, p long")
        assert {r["k"]: (r["root"], r["depth"]) for r in family.roots(df, "k", "p").collect()} == rows
        assert sorted(r["k"] for r in family.cyclic(df, "k", "p").collect()) == sorted(cycles)


def test_equal_keys_on_a_cycle_end(spark):
    # 0 and 1 twice on a cycle, which 2 leads into; beside it a chain that takes some rounds
    chain = [(i, i - 1) for i in range(11, 60)]
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 0), (2, 1), (10, None), *chain], "k long, p long")
    rooted = family.roots(df, "k", "p").where("root is not null")
    assert sorted((r["k"], r["root"], r["depth"]) for r in rooted.collect()) == [(k, 10, k - 10) for k in range(10, 60)]
    assert sorted(r["k"] for r in family.cyclic(df, "k", "p").collect()) == [0, 0, 1, 1, 2]


def test_rounds_do_not_swell_the_plan(spark):
    """A plan's estimated size stays that of its tables; as a product of joins it had thousands of digits after a few rounds."""
    df = spark.createDataFrame([(0, 0), *((i, i - 1) for i in range(1, 2000)), *((i, i - 1) for i in range(3001, 3600))], "k long, p long")
    for found in (family.roots(df, "k", "p"), family.cyclic(df, "k", "p")):
        assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64
