import math
import random
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from memberfold.llm import language_id
from memberfold.llm.language_id import PRIOR_PAGES, declared_likelihoods, host_priors, identify, page_evidence, text_model

SYLLABLES = {"de": ["sch", "ung", "ein", "ä"], "en": ["the", "ing", "wh", "ly"], "fr": ["eau", "ou", "é", "que"]}


def text(language, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[language], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture
def corpus(spark, documents):
    rng = random.Random(1)
    rows = []
    for k in range(150):
        language = ("de", "en", "fr")[k % 3]
        rows.append((k, text(language, 1 + k % 40, rng), "s", language if k % 10 else None))
    rows += [(900, None, "s", "en"), (901, "", "s", "en"), (902, "123 456 !!!", "s", "en"), (None, text("fr", 30, rng), "s", ""), (3, rows[3][1], "s", "de")]
    pages = [(k, f"https://{'www' if k % 2 else 'blog'}.{('a', 'b', 'c')[k % 3]}.org/x", f'<html lang="{("de", "en", "fr")[k % 3].upper()}-XX">') for k in range(100)]
    pages += [(900, None, None), (901, "no url", "<p lang='fr'>"), (None, "http://x.y/", "<html>"), (4, "http://zz.org/", "<html lang=fr>"), (5000, "http://q.w/", None)]
    return rows, documents(rows), spark.createDataFrame(pages, "page_id long, url string, html string")


def test_languages_are_told_and_rest_is_not_accepted(corpus):
    rows, documents, pages = corpus
    found = identify(documents.withColumn("posterior", F.lit("mine")), pages).collect()
    assert len(found) == len(rows)
    for r in found:
        k = r["doc_id"]
        if k is not None and k < 900:
            assert (r["language"], r["accepted"]) == (("de", "en", "fr")[k % 3], True), r
        assert 0 <= r["posterior"] <= 1
    nothing = [r for r in found if r["doc_id"] in (900, 901, 902)]
    assert [(r["language"], r["posterior"], r["accepted"]) for r in nothing] == [(None, 0.0, False)] * 3
    assert [r["language"] for r in found if r["doc_id"] is None] == ["fr"]


def test_text_likelihoods_match_a_plain_count(corpus):
    rows, documents, _ = corpus
    languages, model = text_model(documents)
    assert languages == ["de", "en", "fr"]
    counts = np.full((language_id.CELLS, 3), 0.5)
    for _, t, _, language in rows:
        data = (t or "").encode().lower()
        if language in languages and data.strip():
            data = b" " + data + b" "
            for i in range(len(data) - 2):
                if any(97 <= c <= 122 or c >= 128 for c in data[i : i + 3]):
                    code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
                    counts[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 16, languages.index(language)] += 1
    assert model == pytest.approx(np.log(counts / counts.sum(axis=0)))


def test_host_priors_shrink_level_by_level(spark):
    rows = [("a.x.org", "x.org", "org", "en")] * 9 + [("a.x.org", "x.org", "org", "de")] * 3 + [("b.x.org", "x.org", "org", None)]
    rows += [("y.com", "y.com", "com", "de")] * 5
    labelled = spark.createDataFrame(rows, "host string, domain string, suffix string, language string")
    got = {r["host"]: r["prior"] for r in host_priors(labelled, ["de", "en"]).collect()}
    shrunk = lambda n, total, parent: (n + PRIOR_PAGES * parent) / (total + PRIOR_PAGES)
    for k, (org_host, org, com, every) in enumerate([(3, 3, 5, 8), (9, 9, 0, 9)]):
        top = (every + 1) / (17 + 2)
        domain = shrunk(org, 12, shrunk(org, 12, top))
        assert got["a.x.org"][k] == pytest.approx(shrunk(org_host, 12, domain))
        assert got["b.x.org"][k] == pytest.approx(domain)
        assert got["y.com"][k] == pytest.approx(shrunk(com, 5, shrunk(com, 5, shrunk(com, 5, top))))
    assert all(math.isclose(sum(p), 1) for p in got.values())


def test_pages_sway_short_texts_only(spark, documents):
    rng = random.Random(2)
    rows = [(k, text(("de", "en")[k % 2], 20, rng), "s", ("de", "en")[k % 2]) for k in range(80)]
    rows += [(500, "q", "s", None), (501, "q", "s", None)]
    pages = [(k, f"http://{('d', 'e')[k % 2]}.com/", f"<html lang={('de', 'en')[k % 2]}>") for k in range(80)]
    pages += [(500, "http://d.com/", "<html lang=de>"), (501, "http://e.com/", "<html lang=en>")]
    found = identify(documents(rows), spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r["doc_id"]: r["language"] for r in found.where("doc_id >= 500").collect()} == {500: "de", 501: "en"}


def test_empty_tables(spark, documents):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert identify(documents([]), pages).count() == 0
    row = identify(documents([(1, "text", "s", None)]), pages).first()
    assert (row["language"], row["accepted"]) == (None, False)
    assert identify(documents([(1, "text", "s", "en")]), pages).first()["language"] == "en"
    assert page_evidence(pages).count() == 0


def test_rare_declared_values_keep_their_evidence(spark):
    languages = ["de", "en"]
    rows = [(f"v{k}", languages[k % 2]) for k in range(1500) for _ in range(2)]
    rows += [("v0", "en"), ("v1", None), ("unlabelled", None)]
    found = declared_likelihoods(spark.createDataFrame(rows, "declared string, language string"), languages, "declared")
    found = {r["declared"]: r["heard"] for r in found.collect()}
    known = [r for r in rows if r[1]]
    assert found.keys() == {v for v, _ in known}
    for value in ("v0", "v1", "v1498", "v1499"):
        rate = sum(v == value for v, _ in known) / len(known)
        want = [
            math.log((known.count((value, l)) + PRIOR_PAGES * rate) / (sum(x == l for _, x in known) + PRIOR_PAGES))
            for l in languages
        ]
        assert found[value] == pytest.approx(want)


def test_scores_are_told_from_columns_in_little_memory():
    """A worker holds a few numbers a byte of a small slice, whatever a batch has."""
    rng = np.random.default_rng(2)
    model = np.log(rng.random((language_id.CELLS, 2))).astype(np.float32)
    mean, spread, variance = np.array([-1.0, -0.5]), np.array([0.2, 0.3]), np.array([0.5, 0.4])
    texts = ["word " * 2000 + str(k) for k in range(400)] + [None, "", "123", "zzz"]
    column = pa.array(texts, pa.string())
    tracemalloc.start()
    found = language_id.text_scores(model, mean, spread, variance, column).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20  # 48 MB at 1 MB a slice
    for text, score in zip(texts, found):
        sums, sizes = language_id.text_sums(model, pa.array([text], pa.string()))
        if sizes[0]:
            far = mean - language_id.STRANGE * np.sqrt(spread**2 + variance / sizes[0])
            assert score == {"sums": sums[0].tolist(), "strange": (sums[0] / sizes[0] < far).tolist()}
        else:
            assert score == {"sums": None, "strange": None}


def test_workers_load_no_pandas():
    """Some 27 MB of every worker of the stages, kept until the job ends."""
    code = "import sys, memberfold.llm.language_id, memberfold.llm.ngram_join; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], timeout=60).returncode == 0


def test_languages_are_found_in_a_bounded_number_of_jobs(spark, documents):
    """Each query stays in the driver's memory for a while, with a thread an exchange; these rows took 53 jobs."""
    rows = documents([(1, "the cat and the dog"), (2, "der Hund und die Katze", "a", "de")])
    pages = spark.createDataFrame([(1, "http://a.org/", "<html lang=en>")], "page_id long, url string, html string")
    spark.sparkContext.setJobGroup("languages", "jobs of one identification")
    try:
        identify(rows, pages).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("languages")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 45
