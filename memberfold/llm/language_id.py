"""Language identification by fusing evidence from text and page in one posterior.

Text likelihoods come from byte trigrams counted over all documents of known language.
The page a document was taken from adds the language its markup declares, the suffix
of its address, and a prior of its host, which is smoothed towards the registered
domain's, that towards the suffix's and that towards the prior of all pages. All counts are grouped
aggregations; the tables that tasks are given have a fixed size a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from memberfold.llm.common import ascii_lower, as_bytes, sliced, small_written, written
from memberfold.llm.url_reputation import domain_of, host_of, suffix_of

# Trigrams are counted by hash in so many cells.
CELLS = 1 << 16
# Languages that are told apart; a longer list is refused.
MAX_LANGUAGES = 200
# Pages that a parent's prior is worth.
PRIOR_PAGES = 20.0
# A document is kept if its language's posterior is at least this.
SURE = 0.5
# A text is of no known language if the mean log likelihood of its trigrams lies so many
# standard deviations below that of its likeliest language's documents.
STRANGE = 8.0
# Documents of so many trigrams tell how far such means spread; the least spread, and the
# part that sums are rounded to, so that their order has no effect.
SPREAD_TRIGRAMS, LEAST_SPREAD, PART = 100, 0.2, 1 << 20
# Bytes of text whose trigrams are looked at at once: they take some 40 bytes each.
TRIGRAM_BYTES = 1 << 18
# Multiplier that spreads trigrams over the cells.
_TRIGRAM = np.uint32(0x9E3779B1)


def _cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all trigrams of texts put end to end, and the text of each trigram.

    A space is put before and after each text, so that every text with a character has
    a trigram and none spans two texts.
    """
    framed = [b" " + t.lower() + b" " if t.strip() else b"" for t in texts]
    data = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in framed], np.int64)
    if len(data) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    codes = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    cells = (codes * _TRIGRAM) >> np.uint32(16)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[:-2] == owner[2:]
    # What has no letter (digits, signs, white space) tells no language.
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    inside &= letter[:-2] | letter[1:-1] | letter[2:]
    return cells[inside], owner[:-2][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of one task: an array of all cells for each language it saw."""
    counts: dict[str, np.ndarray] = {}
    for batch in sliced(batches, limit=TRIGRAM_BYTES):
        languages = np.array(batch.column("language").to_pylist(), object)
        cells, owner = _cells(as_bytes(batch.column("text")))
        for language in set(languages):
            own = cells[(languages == language)[owner]]
            counts.setdefault(language, np.zeros(CELLS, np.int64))
            counts[language] += np.bincount(own, minlength=CELLS)
    for language, values in counts.items():
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(values[at])],
            names=["language", "cell", "n"],
        )


def text_counts(documents: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Languages in order with their documents, and counts of the cells, one column a language.

    Counts cover every document whose ``lang`` is neither null nor empty. At most
    MAX_LANGUAGES * CELLS numbers reach the driver.
    """
    known = documents.select(F.col("lang").alias("language"), "text").where("language <> ''")
    found = known.groupBy("language").count().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = {language: n for language, n in sorted(map(tuple, found))}
    counted = known.mapInArrow(_count, "language string, cell int, n long")
    sums = counted.groupBy("language", "cell").agg(F.sum("n").alias("n"))
    counts = np.zeros((CELLS, len(languages)))
    at = {language: k for k, language in enumerate(languages)}
    rows = sums.toArrow()
    columns = [at[x] for x in rows["language"].to_pylist()]
    counts[rows["cell"].to_numpy(), columns] = rows["n"].to_numpy()
    return languages, counts


def _log_likelihoods(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + 0.5
    return np.log(smoothed / smoothed.sum(axis=0))


def text_model(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log likelihoods of the cells, one column a language."""
    languages, counts = text_counts(documents)
    return list(languages), _log_likelihoods(counts)


def text_sums(model: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods of texts under each language, and their numbers of trigrams."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    sums, sizes = [np.zeros((0, model.shape[1]))], [np.zeros(0, np.int64)]
    for part in sliced([batch], limit=TRIGRAM_BYTES):
        cells, owner = _cells(as_bytes(part.column("text")))
        n = part.num_rows
        found = [np.bincount(owner, model[cells, k], minlength=n) for k in range(model.shape[1])]
        sums.append(np.stack(found, axis=1))
        sizes.append(np.bincount(owner, minlength=n))
    return np.concatenate(sums), np.concatenate(sizes)


def expectations(counts: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of a trigram's log likelihood in each language's own documents."""
    share = counts / np.maximum(counts.sum(axis=0), 1)
    mean = (share * model).sum(axis=0)
    return mean, (share * model**2).sum(axis=0) - mean**2


def text_scores(model: np.ndarray, mean: np.ndarray, spread: np.ndarray, variance: np.ndarray, texts: pa.Array) -> pa.StructArray:
    """``sums, strange`` of texts: log likelihoods, and whether they are too low, in each language.

    Both are null for a text without trigrams.
    """
    sums, sizes = text_sums(model, texts)
    has = sizes > 0
    sums, some = sums[has], sizes[has][:, None]
    strange = sums / some < mean - STRANGE * np.sqrt(spread**2 + variance / some)
    offsets = pa.array(np.concatenate([[0], np.cumsum(has) * model.shape[1]]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel()), mask=pa.array(~has)) for x in (sums, strange)]
    return pa.StructArray.from_arrays(lists, names=["sums", "strange"])


def spreads(documents: DataFrame, languages: list[str], table: Broadcast, mean: np.ndarray) -> np.ndarray:
    """How far the means of whole documents of a language lie from its own mean.

    A standard deviation told from the mean distance, which a few odd documents sway little.
    One row a language reaches the driver.
    """
    at = {language: k for k, language in enumerate(languages)}

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(languages), np.int64), np.zeros(len(languages), np.int64)
        for batch in batches:
            own = np.array([at[x] for x in batch.column("language").to_pylist()], np.int64)
            sums, sizes = text_sums(table.value, batch.column("text"))
            long = np.flatnonzero(sizes >= SPREAD_TRIGRAMS)
            own, sizes, sums = own[long], sizes[long], sums[long, own[long]]
            parts = np.rint(np.abs(sums / sizes - mean[own]) * PART).astype(np.int64)
            np.add.at(total, own, parts)
            np.add.at(n, own, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(languages)), pa.int32()), pa.array(total), pa.array(n)], names=["k", "total", "n"]
        )

    known = documents.select(F.col("lang").alias("language"), "text").where("language <> ''")
    sums = known.mapInArrow(distances, "k int, total long, n long").groupBy("k").agg(F.sum("total"), F.sum("n"))
    out = np.full(len(languages), LEAST_SPREAD)
    for k, total, n in sums.collect():
        if n:
            out[k] = max(LEAST_SPREAD, total / PART / n * np.sqrt(np.pi / 2))
    return out


def declared_language(html):
    """The primary subtag of the `lang` attribute of the `html` element; else empty."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{1,8})", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def page_evidence(pages: DataFrame) -> DataFrame:
    """``page_id, host, domain, suffix, declared``: one row a page, the least of each value.

    Pages without an id are left out. A null url or html gives empty values.
    """
    host = host_of(F.col("url"))
    read = pages.where("page_id IS NOT NULL").select(
        "page_id", F.struct(host.alias("host"), declared_language(F.col("html")).alias("declared")).alias("p")
    )
    one = read.groupBy("page_id").agg(F.min("p").alias("p"))
    return one.select(
        F.col("page_id").alias("page"),
        F.col("p.host").alias("host"),
        domain_of(F.col("p.host")).alias("domain"),
        suffix_of(F.col("p.host")).alias("suffix"),
        F.col("p.declared").alias("declared"),
    )


def _smoothed(counts: DataFrame, keys: list[str], parent: str, out: str) -> DataFrame:
    """Add the rate of each language within the keys, shrunk to the column ``parent``."""
    within = Window.partitionBy(*keys)  # one row a language of a member
    total = F.sum("n").over(within)
    return counts.withColumn(out, (F.col("n") + PRIOR_PAGES * F.col(parent)) / (total + PRIOR_PAGES))


def language_sums(labelled: DataFrame, languages: list[str]) -> dict[str, int]:
    """Rows of each of the languages."""
    known = labelled.where(F.col("language").isin(languages))
    return {r[0]: r[1] for r in known.groupBy("language").count().collect()}


def host_priors(labelled: DataFrame, languages: list[str], sums: dict[str, int] | None = None) -> DataFrame:
    """``host, prior``: the probability of each language, in order, on every host.

    ``labelled`` is ``host, domain, suffix, language`` (null: unknown language), ``sums`` what
    ``language_sums`` finds in it.
    """
    sums = language_sums(labelled, languages) if sums is None else sums
    listed = F.array(*map(F.lit, languages))
    counts = labelled.groupBy("host", "domain", "suffix", "language").agg(F.count("*").alias("n"))
    counts = written(counts, "hosts")
    known = counts.where(F.col("language").isin(languages))

    def level(keys: list[str]) -> DataFrame:
        members = counts.select(*keys).distinct().withColumn("language", F.explode(listed))
        sums = known.groupBy(*keys, "language").agg(F.sum("n").alias("n"))
        return members.join(sums, [*keys, "language"], "left").na.fill(0, ["n"])

    total = sum(sums.values())
    even = F.create_map(
        *[F.lit(x) for l in languages for x in (l, (sums.get(l, 0) + 1.0) / (total + len(languages)))]
    )
    suffixes = _smoothed(level(["suffix"]).withColumn("all", even[F.col("language")]), ["suffix"], "all", "s")
    domains = level(["suffix", "domain"]).join(suffixes.select("suffix", "language", "s"), ["suffix", "language"])
    domains = _smoothed(domains, ["suffix", "domain"], "s", "d").select("domain", "suffix", "language", "d")
    hosts = level(["suffix", "domain", "host"]).join(domains, ["suffix", "domain", "language"])
    hosts = _smoothed(hosts, ["host"], "d", "h")
    prior = F.transform(F.array_sort(F.collect_list(F.struct("language", "h"))), lambda x: x["h"])
    return hosts.groupBy("host").agg(prior.alias("prior"))


def declared_likelihoods(
    labelled: DataFrame, languages: list[str], column: str, sums: dict[str, int] | None = None
) -> DataFrame:
    """``column, heard``: log probabilities of every declared value under each language, in
    order, shrunk to the value's rate.

    A value without a document of known language has no row. ``sums`` is what ``language_sums``
    finds in the rows.
    """
    counts = labelled.where(F.col("language").isin(languages)).groupBy(column, "language").agg(F.count("*").alias("n"))
    counts = written(counts, "declared")
    sums = language_sums(labelled, languages) if sums is None else sums
    every = max(sum(sums.values()), 1)
    listed = F.array(
        *[F.struct(F.lit(l).alias("language"), F.lit(sums.get(l, 0) + PRIOR_PAGES).alias("total")) for l in languages]
    )
    values = counts.groupBy(column).agg(
        F.map_from_entries(F.collect_list(F.struct("language", "n"))).alias("of"), F.sum("n").alias("rate")
    )
    expected = F.col("rate") * F.lit(PRIOR_PAGES / every)
    heard = F.transform(
        listed, lambda x: F.log((F.coalesce(F.try_element_at("of", x["language"]), F.lit(0)) + expected) / x["total"])
    )
    return values.select(column, heard.alias("heard"))


_FOUND = "__lid"


def _identified(documents: DataFrame, pages: DataFrame, sure: float) -> DataFrame:
    """The documents, all their columns, with what is found in one struct of a reserved name."""
    sums, counts = text_counts(documents)
    languages = list(sums)
    if not languages:
        nothing = F.struct(
            F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted")
        )
        return documents.withColumn(_FOUND, nothing)
    model = _log_likelihoods(counts)
    mean, variance = expectations(counts, model)
    table = documents.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    spread = spreads(documents, languages, table, mean)

    @F.arrow_udf("sums array<double>, strange array<boolean>")
    def likelihoods(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield text_scores(table.value, mean, spread, variance, texts)

    evidence = written(page_evidence(pages), "pages")
    of = documents.select(F.col("doc_id").alias("page"), F.col("lang").alias("language"))
    # A document that comes more than once counts once; its least language stands.
    of = of.where("page IS NOT NULL").groupBy("page").agg(F.min("language").alias("language"))
    labelled = written(evidence.join(of, "page"), "labelled")
    paged = language_sums(labelled, languages)
    said = small_written(declared_likelihoods(labelled, languages, "declared", paged), "heard")
    prior = host_priors(labelled, languages, paged)
    fused = evidence.join(prior, "host").select("page", "declared", F.transform("prior", lambda p: F.log(p)).alias("prior"))
    heard = F.coalesce("heard", F.array(*[F.lit(0.0)] * len(languages)))
    fused = fused.join(said, "declared", "left")
    fused = fused.select(
        F.col("page").alias("__lid_page"), F.zip_with("prior", heard, lambda a, b: a + b).alias("__lid_more")
    )
    fused = small_written(fused, "fused")
    total = sum(sums.values())
    even = F.array(*[F.lit(float(np.log((sums[l] + 1) / (total + len(languages))))) for l in languages])
    # The text goes no further than the scan: what is joined is a row of numbers.
    scored = documents.select("*", likelihoods("text").alias("__lid_text"))
    joined = scored.join(fused, scored["doc_id"] == F.col("__lid_page"), "left")
    both = F.zip_with("__lid_text.sums", F.coalesce("__lid_more", even), lambda a, b: a + b)
    best = F.array_max(both)
    posterior = 1 / F.aggregate(both, F.lit(0.0), lambda s, x: s + F.exp(x - best))
    first = F.array_position(both, best).cast("int")
    language = F.element_at(F.array(*map(F.lit, languages)), first)
    strange = F.coalesce(F.element_at("__lid_text.strange", first), F.lit(True))
    posterior = F.coalesce(posterior, F.lit(0.0))
    found = F.struct(
        F.when(both.isNotNull(), language).alias("language"),
        posterior.alias("posterior"),
        ((posterior >= sure) & ~strange).alias("accepted"),
    )
    return joined.select(*[scored[c] for c in documents.columns], found.alias(_FOUND))


def identify(documents: DataFrame, pages: DataFrame, sure: float = SURE) -> DataFrame:
    """The documents, whole rows, with ``language``, ``posterior`` and ``accepted``.

    ``pages`` is ``page_id, url, html``; a document's page is the one whose page_id is its
    doc_id. ``language`` is the likeliest one (ties: the first by name) and null where
    the text has no letters. Such a document is not accepted, and neither is one whose
    trigrams are far less likely than those of that language's documents: text of a
    language without labels, or no language. The posterior tells known languages apart and
    does not count that. One without a page has the prior of all documents of known
    language. The result's columns replace columns of the documents with these names.
    Without any document of known language nothing is accepted. A text of any length is
    handled whole; a task holds a few numbers a byte of one slice, or of one long text.
    """
    own = [c for c in documents.columns if c not in ("language", "posterior", "accepted")]
    return _identified(documents, pages, sure).select(*own, f"{_FOUND}.*")


def accepted_documents(documents: DataFrame, pages: DataFrame, sure: float = SURE) -> DataFrame:
    """The documents that ``identify`` accepts, with the columns they came with."""
    return _identified(documents, pages, sure).where(f"{_FOUND}.accepted").select(*documents.columns)
