import duckdb
import pytest

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) or longer rows."""
    def make(rows, **more):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        for k, v in more.items():
            df = df.withColumn(k, F.lit(v))
        return df
    return make


@pytest.fixture
def oracle(spark):
    """Rows of a DuckDB query over Spark tables, as sorted tuples by column name."""
    def run(sql, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            con.register(name, df.toArrow() if hasattr(df, "columns") else df)
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        return rows_of([dict(zip(names, r)) for r in got.fetchall()])
    return run


def rows_of(rows):
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    out = [tuple((k, norm(v)) for k, v in sorted((r.asDict() if hasattr(r, "asDict") else r).items())) for r in rows]
    return sorted(out, key=repr)
