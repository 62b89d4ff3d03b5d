"""Orders that must hold however often and over however many partitions a plan is computed."""

import duckdb

from annolith.plans import ORACLES, library


def test_failed_first_numbers_by_keys(spark, tmp_path):
    """over several ranges a place came from the partitions of sorted rows, which differ between computations."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT range AS c_custkey FROM range(250000)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT range * 7 % 260000 AS o_custkey, CASE WHEN range % 5 = 0 THEN 'P' ELSE 'F' END AS o_orderstatus FROM range(200000)) TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    for name in ("customer", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    library.failed_first(spark, str(tmp_path)).write.parquet(str(tmp_path / "got"))
    differs = con.execute(f"SELECT count(*) FROM ((SELECT uid, n FROM '{tmp_path}/got/*.parquet') EXCEPT ALL ({ORACLES['failed_first']}))").fetchone()
    assert differs == (0,) and con.execute(f"SELECT count(*) FROM '{tmp_path}/got/*.parquet'").fetchone() == (250000,)
