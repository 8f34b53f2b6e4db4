import datetime as dt
import hashlib

from ratevane.plans.catalogue import QUERIES


def test_aliases_of_all_parts(spark, tmp_path):
    parts = [(i, i % 7) for i in (1, 5, 12, 499, 500, 501, 977, 1600, 1999)]
    orders = [(i, i % 9, dt.datetime(1995, 1, 1) + dt.timedelta(days=17 * i)) for i in range(80)]
    spark.createDataFrame(parts, "p_partkey bigint, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    wanted = []
    for key, customer, at in orders:
        day, found = at.date(), []
        for part, size in parts:
            begin = dt.date(1995, 1, 1) + dt.timedelta(days=part % 40 * 30)
            if size == customer % 50 and (part % 3 == 0 or begin <= day) and (part % 5 == 0 or day < begin + dt.timedelta(days=60)):
                found.append(str(part))
        wanted += [(key, f"brand{customer % 50}", day.isoformat(), x) for x in found or [None]]
    got = [tuple(r) for r in QUERIES["alias_lookup_all"](spark, str(tmp_path)).select("o_orderkey", "alias", "day", "canonical").collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str) and any(x and int(x) >= 500 for *_, x in wanted)


def test_base_of_all_pages(spark, tmp_path):
    ids = [*range(1, 30), *range(440, 500), 900, 2250]
    spark.createDataFrame([(i,) for i in ids], "page_id bigint").write.parquet(f"{tmp_path}/pages.parquet")
    best = {}
    for i in ids:
        sha, base = hashlib.sha256(str(i).encode()).hexdigest(), i % 9 == 0
        rank = (str(i % 4), base, 0 if base else i, sha)  # the newest fetch; of equal ones the base (there by sha), then the newest branch
        key = (f"s{i % 3}", f"u{i % 50}")
        best[key] = max(best.get(key, (("",), "", False)), (rank, sha, base))
    seen = {k: (sha, rank[0], base) for k, (rank, sha, base) in best.items()}
    rows = QUERIES["resolved_channels"](spark, str(tmp_path)).collect()
    got = {(r.source, r.url): (r.sha, r.fetched, r.from_base) for r in rows}
    assert got == seen
    assert any(v[2] and v[0] in {hashlib.sha256(str(i).encode()).hexdigest() for i in (450, 459, 468, 477, 486, 495, 900, 2250)} for v in got.values())
