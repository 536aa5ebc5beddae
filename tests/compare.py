"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(normal(r[i]) for i in order) for r in result.fetchall()), key=key)


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(normal(v) for v in r) for r in frame.select(*[f"`{n}`" for n in names]).collect()), key=key)


def difference(spark, con, query, sf_dir):
    """None when equal, else a short description."""
    got_names, got = spark_rows(query.run(spark, sf_dir))
    if query.sql is None:
        return None if got else "no rows"
    names, expected = duck_rows(con, query.sql)
    if got_names != names:
        return f"columns {got_names} != {names}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}; first {got[:1]} / {expected[:1]}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None if got else "no rows on either side"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from notewright.plans.registry import load_register
    from notewright.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, entry in load_register().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, entry, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
