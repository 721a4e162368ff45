import duckdb
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text[, source[, lang]]) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture
def sql():
    def run(query, **tables):
        connection = duckdb.connect()
        for name, frame in tables.items():
            connection.register(name, frame.toArrow())
        cursor = connection.execute(query)
        names = [c[0] for c in cursor.description]
        return [dict(zip(names, row)) for row in cursor.fetchall()]

    return run
