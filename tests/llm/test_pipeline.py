import base64
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from memberfold.llm import token_file
from memberfold.llm.queries import held_out, queries

SF_DIR = "/root/testdata/sf0.001"


def words(n, rng):
    return " ".join("".join(rng.choices(["the", "ing", "wh", "ly"], k=3)) for _ in range(n))


@pytest.fixture
def tables(spark, documents, tmp_path):
    rng = random.Random(8)
    item = words(30, rng)
    rows = [(k, words(60 + k, rng), ("a", "b", None)[k % 3]) for k in range(60)]
    rows += [(100, rows[5][1]), (101, rows[6][1] + " more"), (102, words(40, rng) + " " + item), (103, None), (104, "123"), (105, "")]
    pages = spark.createDataFrame([(1, "http://a.org/", "<html lang=en>")], "page_id long, url string, html string")
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    for name, frame in (("documents", documents(rows)), ("pages", pages), ("benchmark", benchmark)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_each_stage_takes_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, gone = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == columns, name
        path = f"{tables}/{name}"
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        gone.append({r[0] for r in docs.select("doc_id").collect()} - {r[0] for r in kept.select("doc_id").collect()})
        docs = kept
    assert gone[:3] == [{103, 104, 105}, {100, 101}, {102}]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    encoder = token_file.Encoder(corpus_pipeline.tokenizer_path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], len(encoder.encode([r["text"]])[0]) // 4 + 1) for r in docs.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in last) == want
    assert sum(r["n_tokens"] for r in last) == max(r["start"] + r["n_tokens"] for r in last)


CLASHING = {
    "language": "string", "posterior": "string", "accepted": "string", "size": "string", "source_size": "string",
    "target": "string", "copies": "string", "sid": "string", "label": "string", "name": "string", "n": "int",
    "hash": "string", "shingle": "string", "item_id": "int", "key": "string", "rank": "string", "page": "string",
    "host": "string", "prefix": "int", "component": "int", "node": "int", "times": "int", "n_tokens": "string", "ids": "string",
}


def test_stages_leave_further_columns_alone(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    own = F.concat(F.lit("own "), F.coalesce("doc_id", F.lit(-1)))
    values = {"string": own, "int": F.col("doc_id").cast("int")}
    wide = docs.select("*", *[values[kind].alias(name) for name, kind in CLASHING.items()])
    want, gone = {r["doc_id"]: r for r in wide.collect()}, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, wide, tables).write.parquet(f"{tables}/wide-{name}")
        out = spark.read.parquet(f"{tables}/wide-{name}")
        rows = out.collect()
        assert out.dtypes == wide.dtypes, name
        assert all(want[r["doc_id"]] == r for r in rows), name
        gone.append({r[0] for r in wide.select("doc_id").collect()} - {r["doc_id"] for r in rows})
        wide = out
    assert gone[:3] == [{103, 104, 105}, {100, 101}, {102}]
    last = corpus_pipeline.STAGES[-1][1](spark, wide, tables).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in wide.collect())


def test_stages_of_no_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        assert out.count() == 0, name
        docs = out if out.columns == docs.columns else docs


BASQUE = [
    "Euskal Herriko mendietan elurra egin du gaur goizean eta hotz handia dago",
    "Gizon-emakume guztiak aske jaiotzen dira, duintasun eta eskubide berberak dituztela",
    "Etxean nago eta liburu bat irakurtzen ari naiz arratsaldean",
    "Bihar Donostiara joango naiz lagunekin hondartzara",
    "Hizkuntza bat ez da galtzen ez dakitenek ikasten ez dutelako, dakitenek hitz egiten ez dutelako baizik",
]


def test_unknown_languages_and_junk_go_and_documents_stay(spark):
    rng = random.Random(4)
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    junk = [base64.b64encode(rng.randbytes(200)).decode() for _ in range(10)]
    junk += ["{{#if user}}{{user.name}}{{/if}} %%VAR%% <?php echo $x; ?> {{> footer}}" * k for k in range(1, 6)]
    strange = [*junk, *BASQUE, " ".join(BASQUE), *[BASQUE[k] + " " + BASQUE[k - 1] for k in range(1, 5)]]
    rows = [(10_000_000 + k, t, None, "x", len(t)) for k, t in enumerate(strange)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.identified(spark, both, sf_dir).select("doc_id").collect()}
    assert not kept & {r[0] for r in rows}
    told = {r["doc_id"] for r in docs.where("text RLIKE '[a-z]'").collect()}
    # Of a thousand documents a few consist of little but secrets or numbers.
    assert len(told - kept) <= 5


def test_runs_on_a_given_table(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries()["op6_quality_crf"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where(held_out()).collect()
    assert all(r["held_out"] for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_language_of_given_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries()["op10_language_id"](spark, sf_dir)
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").collect()
    assert sum(r["language"] == r["lang"] and r["accepted"] for r in rows) / len(rows) > 0.98
