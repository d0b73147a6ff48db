"""Run registered queries and compare them with their SQL: ``python tests/check.py SF|FOLDER [NAME ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from blockloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_rows(sf_dir, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = connection.execute(sql)
    return normal([c[0] for c in result.description], result.fetchall())


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(frame):
    return normal(frame.columns, [tuple(row) for row in frame.collect()])


def main():
    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    if "/" not in sf_dir:
        sf_dir = f"/root/testdata/sf{sf_dir}"
    spark = local_session("check", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    oracles, failed = driver.oracle_sql(), []
    for name, query in driver.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            names, rows = spark_rows(query(spark, sf_dir))
        except Exception as error:
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            failed.append(name)
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"rows  {name}: {len(rows)} rows, {took:.2f} s", flush=True)
            continue
        expected = oracle_rows(sf_dir, oracles[name])
        same = (names, rows) == expected
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(rows)} rows, {took:.2f} s", flush=True)
        if not same:
            failed.append(name)
            print("   ", names, expected[0], len(expected[1]))
            for ours, theirs in list(zip(rows, expected[1])):
                if ours != theirs:
                    print("   ", str(ours)[:400], "\n   ", str(theirs)[:400])
                    break
    print("failed:", failed)


if __name__ == "__main__":
    main()
