"""Language ID: Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, chunks, map_arrow, mixed, saved

#: Labelled documents of each language that the text model is fitted on, at most,
#: and the characters of each that it is fitted on (pages are read whole).
SAMPLE_PER_LANGUAGE = 1_500
SAMPLE_CHARS = 100_000
SLOTS_BITS = 13
#: Neighbouring byte triples overlap, so each counts as a third of an observation.
TEMPER = 1 / 3
#: Pages that a host, and a domain, count for beside their own.
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 5.0
#: Added to each count of the declared and the address language.
SMOOTHING = 1.0

_HIDDEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|$)"
                     r"|<[^>]*>", re.DOTALL | re.IGNORECASE)


def visible(page: str) -> str:
    """The text of a page without markup, white space runs as one space."""
    return " ".join(html.unescape(_HIDDEN.sub(" ", page)).split())


def triples(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte triples of each text, ASCII case ignored: (slot, text)."""
    data = LOWER[data].astype(np.uint64)
    if len(data) < 3:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    code = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = text[2:] == text[:-2]
    return (mixed(code[same]) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64), text[2:][same]


def _sizes(known: DataFrame) -> DataFrame:
    """(lang, rows): about how many different rows each language has."""
    return saved(known.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("doc_id", "text")).alias("rows")), "language-sizes")


def _sample(known: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, text) of at most SAMPLE_PER_LANGUAGE different rows of each language.

    One scan keeps by hash some twice as many as are wanted, so what is ranked does
    not grow with the table; ``sizes`` has a row a language.
    """
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("row"))
    chance = F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(1 << 30)) / float(1 << 30)
    some = known.join(F.broadcast(sizes), "lang").where(
        chance * F.col("rows") <= 2.0 * SAMPLE_PER_LANGUAGE).select("lang", "row").distinct()
    ranked = some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(3), "row"), "row")))
    chosen = saved(ranked.where(F.col("rank") <= SAMPLE_PER_LANGUAGE).select("lang", "row"),
                   "language-sample")
    return (known.join(chosen, ["lang", "row"], "left_semi")
            .select("lang", "row", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
            .dropDuplicates(["lang", "row"]).select("lang", "text"))


def train(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-likelihood of each hashed byte triple in each of them.

    Every language of a document with text is told apart, however many there are.
    Counts a bounded sample of labelled documents by grouped aggregation; the
    driver gets at most 2**SLOTS_BITS counts a language (64 KB).
    """
    known = documents.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    sizes = _sizes(known)
    languages = sorted(row["lang"] for row in sizes.select("lang").collect())
    counts = np.full((len(languages), 1 << SLOTS_BITS), 0.5)
    if not languages:
        return languages, counts
    sample = _sample(known, sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {language: i for i, language in enumerate(languages)}
        total = np.zeros((len(languages), 1 << SLOTS_BITS), dtype=np.int64)
        for batch in batches:
            of = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()])
            for first, end, data, offsets in chunks(batch.column("text")):
                slot, text = triples(data, offsets)
                row = of[first:end][text]
                np.add.at(total, (row[row >= 0], slot[row >= 0]), 1)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)),
             pa.array(total[at])], ["language", "slot", "n"])

    rows = (map_arrow(sample, count, "language int, slot int, n bigint")
            .groupBy("language", "slot").agg(F.sum("n").alias("n")).toArrow())
    np.add.at(counts, (rows.column("language").to_numpy(), rows.column("slot").to_numpy()),
              rows.column("n").to_numpy())
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def text_evidence(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """``pages`` with ``text_log``, an array of each language's log-likelihood, for html."""
    kept = pages.drop("text_log")
    at = kept.columns.index("html")
    names = [name for name in kept.columns if name != "html"]
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = pa.array([visible(page or "") for page in batch.column(at).to_pylist()],
                             pa.large_string())
            logs = np.zeros((batch.num_rows, len(model)))
            for first, end, data, offsets in chunks(texts):
                slot, text = triples(data, offsets)
                for k, row in enumerate(model):
                    logs[first:end, k] = np.bincount(text, row[slot], end - first) * TEMPER
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names),
                 pa.array(list(logs), pa.list_(pa.float64()))], [*names, "text_log"])

    return map_arrow(kept, apply, T.StructType(
        [*(f for f in kept.schema.fields if f.name != "html"),
         T.StructField("text_log", T.ArrayType(T.DoubleType()))]))


def _among(code: Column, languages: list[str]) -> Column:
    """``code`` if it is a known language; ``other``, or ``none`` for no code."""
    return (F.when(code == "", "none").when(code.isin(languages), code).otherwise("other"))


def declared(page: Column) -> Column:
    """The language that the html element or a Content-Language tag names, lower case."""
    head = F.coalesce(page, F.lit(""))
    of_html = F.regexp_extract(head, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    of_meta = F.regexp_extract(
        head, r"(?i)<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.lower(F.when(of_html != "", of_html).otherwise(of_meta))


def host_of(url: Column) -> Column:
    """The host of an address, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def address_code(url: Column) -> Column:
    """The language code of an address: its first path part, else its top-level domain."""
    part = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    r"^[A-Za-z][\w+.-]*://[^/?#]+/([A-Za-z]{2})(?:[-_/?#]|$)", 1))
    suffix = F.regexp_extract(host_of(url), r"\.([a-z]{2})$", 1)
    return F.when(part != "", part).otherwise(suffix)


def _normal(frame: DataFrame, logs: list[str], name: str) -> DataFrame:
    """``frame`` with ``name``: probabilities of the sum of arrays of logarithms.

    In numpy, as nested array functions would be evaluated anew for each element.
    """
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = sum(_rows(batch.column(log)) for log in logs)
            raised = np.exp(total - total.max(axis=1, keepdims=True, initial=-np.inf))
            shares = raised / raised.sum(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(shares), pa.list_(pa.float64()))],
                [*batch.schema.names, name])

    return map_arrow(frame, apply, T.StructType(
        [*frame.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


def _rows(arrays: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(len(arrays), -1) \
        if len(arrays) else np.zeros((0, 1))


def _soft(frame: DataFrame, by: list[str], column: str) -> DataFrame:
    """(by, k, s): the sum of each place of an array of probabilities, zeros left out."""
    return (frame.select(*by, F.posexplode(column).alias("k", "p")).where("p > 0")
            .groupBy(*by, "k").agg(F.sum("p").alias("s")))


def _arrays(soft: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """``by``, ``name`` and ``mass``: the sums of each group as an array of ``size`` places,
    and their total."""
    zeros = soft.select(*by).distinct().select(
        *by, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("k"), F.lit(0.0).alias("s"))
    dense = soft.select(*by, "k", "s").union(zeros).groupBy(*by, "k").agg(F.sum("s").alias("s"))
    return dense.groupBy(*by).agg(
        F.sum("s").alias("mass"), F.array_sort(F.collect_list(F.struct("k", "s"))).alias("e")
    ).select(*by, F.transform("e", lambda x: x["s"]).alias(name), "mass")


def _plus(a: str, b: str | Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _reliability(frame: DataFrame, by: str, name: str, languages: list[str]) -> DataFrame:
    """``frame`` with ``name``, log P(code | language), from all rows' soft counts.

    There are at most two codes more than languages.
    """
    codes = [*languages, "other", "none"]
    place = {code: i for i, code in enumerate(codes)}
    counts = np.full((len(codes), len(languages)), SMOOTHING)
    for row in _soft(frame, [by], "p").collect():
        counts[place[row[by]], row["k"]] += row["s"]
    logs = np.log(counts / counts.sum(axis=0, keepdims=True))
    table = frame.sparkSession.createDataFrame(
        list(zip(codes, logs.tolist())), f"{by} string, {name} array<double>")
    return frame.join(table, by)


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, url, lang, probability, text_lang, declared, address) of every page.

    The text gives a likelihood of each language (byte triples, fitted on labelled
    documents).  How far a declared language and an address code can be trusted is
    counted over all pages against the text's verdict.  A host's prior is its
    pages' soft counts, smoothed towards its domain's, and that towards the whole;
    hosts are aggregated with map-side sums, so a host with a third of all pages
    is a few rows, and joined back with the plain equality that adaptive
    execution may split.  The tables of codes grow with the square of the number of
    languages: 32 MB for 2,000.

    A NULL or empty page has no text evidence and is decided by the rest, NULL
    addresses share the empty host; rows that repeat a page_id stand each for
    itself.  Without labelled documents lang is NULL.  Ties go to the language
    first in alphabetical order.
    """
    languages, model = train(documents)
    if not languages:
        nothing = F.lit(None).cast("string")
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), "url", nothing.alias("lang"),
            F.lit(None).cast("double").alias("probability"), nothing.alias("text_lang"),
            F.lit("none").alias("declared"), F.lit("none").alias("address"))
    size = len(languages)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"),
        _among(address_code(F.col("url")), languages).alias("address"),
        _among(declared(F.col("html")), languages).alias("declared"), "html")
    rows = rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
    rows = saved(_normal(text_evidence(rows, model), ["text_log"], "p"), "language-evidence")
    rows = _reliability(_reliability(rows, "declared", "d", languages), "address", "a", languages)
    own = _normal(rows.select("host", "domain", "text_log", "d", "a"), ["text_log", "d", "a"], "q")
    soft = saved(_soft(own, ["host", "domain"], "q"), "language-hosts")
    base = np.full(size, SMOOTHING)
    for row in soft.groupBy("k").agg(F.sum("s").alias("s")).collect():
        base[row["k"]] += row["s"]
    whole = F.array(*(F.lit(float(b)) for b in DOMAIN_WEIGHT * base / base.sum()))
    domains = _arrays(soft.groupBy("domain", "k").agg(F.sum("s").alias("s")), ["domain"], size, "n")
    domains = domains.select("domain", F.transform(
        _plus("n", whole), lambda x: x / (F.col("mass") + DOMAIN_WEIGHT)).alias("of_domain"))
    hosts = _arrays(soft, ["host", "domain"], size, "n").join(domains, "domain")
    priors = hosts.select("host", F.transform(
        F.zip_with("n", "of_domain", lambda n, d: n + HOST_WEIGHT * d),
        lambda x: F.log(x / (F.col("mass") + HOST_WEIGHT))).alias("prior"))
    fused = _normal(rows.join(priors, "host"), ["text_log", "d", "a", "prior"], "r")

    def best(column: str) -> Column:
        at = F.array_position(column, F.array_max(column)).cast("int")
        return F.element_at(F.array(*map(F.lit, languages)), at)

    return fused.select("page_id", "url", best("r").alias("lang"),
                        F.array_max("r").alias("probability"), best("p").alias("text_lang"),
                        "declared", "address")
