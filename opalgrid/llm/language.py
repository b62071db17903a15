"""Language identification by Bayesian fusion of evidence.

The text's likelihood under each language (hashed character trigrams) is multiplied by what a declared markup language
and an address's suffix say, and by a prior for the host, which leans on its domain's, which leans on everyone's. Priors
and the reliability of declarations are counted by grouped aggregation over all rows, from what the texts alone say.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, cut, pieces_of, text_of
from opalgrid.llm.fitting import fitted

#: Rows that the trigram model is fitted on, its buckets, and characters of each of them that it looks at.
MOST, BUCKETS = 3000, 1 << 14
#: Trigrams overlap and depend on each other: a text's likelihood counts as that of at most this many.
EFFECTIVE = 60
#: Rows that a host's prior leans on its domain's with, and a domain's on everyone's.
LEAN = 20.0
#: Hosts whose priors are broadcast; more are joined.
FEW_HOSTS = 100_000
#: A text whose best language is less probable than this is rejected, and so is one with fewer letters.
LEAST, LETTERS = 0.5, 2


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages): log likelihoods
    letters: np.ndarray  # which code points are letters


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _trigrams(texts: Sequence[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams of letters and blanks of all texts, their text, and the number of letters of each text.
    A run of anything but letters counts as one blank."""
    joined = " \n".join(["", *texts]).lower() + " "
    p = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(p == 10)
    if owner[-1] != len(texts):  # a text holds line ends of its own
        joined = " \n".join(["", *(t.replace("\n", " ") for t in texts)]).lower() + " "
        p = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.cumsum(p == 10)
    is_letter = letters[p]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of others
    q, own = np.where(is_letter, p, 32)[keep].astype(np.uint32), owner[keep]
    counts = np.bincount(owner[is_letter], minlength=len(texts) + 1)[1:]
    if len(q) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), counts
    h = (q[:-2] * np.uint32(0x9E3779B1)) ^ (q[1:-1] * np.uint32(0x85EBCA77)) ^ (q[2:] * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    same = own[2:] == own[:-2]
    return (h >> np.uint32(18))[same].astype(np.int64), own[2:][same] - 1, counts


def fit(rows: pd.DataFrame) -> Model:
    """The model of rows text, lang. Without rows it knows no language."""
    languages = sorted(set(rows["lang"])) if len(rows) else []
    letters, table = _letters(), np.zeros((BUCKETS, len(languages)), np.float32)
    for k, lang in enumerate(languages):
        texts = rows["text"][rows["lang"] == lang].tolist()
        n = np.full(BUCKETS, 0.5)
        for s in pieces_of([len(t) for t in texts], 1_000_000):
            n += np.bincount(_trigrams(texts[s], letters)[0], minlength=BUCKETS)
        table[:, k] = np.log(n / n.sum())
    return Model(languages, table, letters)


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = MOST) -> Model:
    """A trigram model fitted on `most` rows with a language, drawn by a hash of their key and text."""
    rows = docs.where(F.col(lang).isNotNull()).select(text_of(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(key, F.length(text_of(text))).alias("h"))
    some = rows.where(F.length("text") > 0)
    # Hashes alone are ordered; texts are read for those below the last of them only, and once for each hash.
    last = some.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return fitted(some.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).select("text", "lang"), fit)


def likelihoods(model: Model, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Tempered log likelihoods (texts, languages) and numbers of letters."""
    out, letters = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    for s in pieces_of([len(t) for t in texts], 200_000):
        part = texts[s]
        bucket, owner, counts = _trigrams(part, model.letters)
        n = np.bincount(owner, minlength=len(part))
        for k in range(len(model.languages)):
            out[s, k] = np.bincount(owner, model.table[bucket, k], len(part))
        out[s] *= (np.minimum(1.0, EFFECTIVE / np.maximum(n, 1)))[:, None]
        letters[s] = counts
    return out, letters


def with_text(rows: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """rows with _lik, the log likelihood of each language, and _letters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lik: array<double>, letters: long>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        claim("language")
        for part in parts:
            lik, letters = likelihoods(shared.value, part.tolist())
            yield pd.DataFrame({"lik": list(lik), "letters": letters})

    # Not deterministic in name only: else conditions on its result are pushed below it, and each task has a second Python
    # process that looks at all texts once more.
    found = rows.withColumn("_text", of.asNondeterministic()(text_of(text)))
    return found.withColumns({"_lik": F.col("_text.lik"), "_letters": F.col("_text.letters")}).drop("_text")


def _posterior(logs: Column) -> Column:
    """exp(logs) over their sum; an array."""
    most = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - most))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _added(*arrays: Column) -> Column:
    out = arrays[0]
    for a in arrays[1:]:
        out = F.zip_with(out, a, lambda x, y: x + y)
    return out


def _sums(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """by, sums (array of the sums of _post over languages), total."""
    parts = [F.sum(F.element_at("_post", k + 1)).alias(f"_s{k}") for k in range(n)]
    return rows.groupBy(*by).agg(*parts).select(*by, F.array(*[f"_s{k}" for k in range(n)]).alias("sums"))


def _total(a: Column | str) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


@dataclass
class Priors:
    hosts: DataFrame  # host, prior (logs)
    declared: DataFrame  # declared, said (logs)
    suffixes: DataFrame  # suffix, told (logs)
    everyone: list[float]


def _reliable(rows: DataFrame, column: str, name: str, n: int) -> DataFrame:
    """log P(value | language) for each value of a declaration, smoothed; at most as many rows as there are values."""
    counts = _sums(rows.where(F.col(column).isNotNull()), [column], n)
    of_language = counts.agg(*[F.sum(F.element_at("sums", k + 1)).alias(f"_n{k}") for k in range(n)], F.count("*").alias("_values"))
    logs = F.array(*[F.log((F.element_at("sums", k + 1) + 0.5) / (F.col(f"_n{k}") + 0.5 * F.col("_values"))) for k in range(n)])
    return counts.join(F.broadcast(of_language)).select(column, logs.alias(name))  # of_language is one row


def priors(evidence: DataFrame, model: Model) -> Priors:
    """Counts over all rows of evidence (_lik, host, domain, declared, suffix), from what each text alone says."""
    n = len(model.languages)
    flat = [-float(np.log(max(1, n)))] * n
    rows = evidence.withColumn("_post", F.when(F.col("_letters") >= LETTERS, _posterior(F.col("_lik")))).where("_post IS NOT NULL")
    counts = cut(_sums(rows.select("host", "domain", "declared", "suffix", "_post"), ["host", "domain", "declared", "suffix"], n))
    again = counts.withColumn("_post", F.col("sums"))
    whole = _sums(again, [], n).first()
    sums = np.array([x or 0.0 for x in whole["sums"]]) + 1.0
    everyone = (sums / sums.sum()).tolist()
    common = F.lit([float(x) for x in everyone])
    leaned = lambda s, on: F.zip_with(s, on, lambda x, y: (x + LEAN * y) / (_total(s) + LEAN))
    domains = _sums(again, ["domain"], n).select("domain", leaned(F.col("sums"), common).alias("of_domain"))
    hosts = _sums(again.where(F.col("host").isNotNull()), ["host", "domain"], n).withColumn("_d", F.coalesce("domain", F.lit(""))).join(domains.select(F.coalesce("domain", F.lit("")).alias("_d"), "of_domain"), "_d")
    named = hosts.select("host", F.transform(leaned(F.col("sums"), F.col("of_domain")), lambda x: F.log(x)).alias("prior"), _total("sums").alias("_n"))
    once = named.groupBy("host").agg(F.max_by("prior", "_n").alias("prior"))  # a host has one domain
    return Priors(cut(once), cut(_reliable(again, "declared", "said", n)), cut(_reliable(again, "suffix", "told", n)), [float(np.log(x)) for x in everyone] or flat)


def identified(rows: DataFrame, model: Model, *, text: str = "text", host: Column | None = None, domain: Column | None = None, declared: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """rows with lang_found, probability, text_lang (what the text alone says) and accepted; all other columns stay,
    and columns of these names are replaced.

    Rejected, with lang_found null: texts with fewer than two letters, and texts whose best language is less probable than
    one half. Missing evidence counts for nothing; a null text is empty. Ties between languages go to the one that comes
    first by name. Repeated rows each count and each give a row; texts of any length are taken whole. Two passes over the
    texts: one for the priors, one for the result.
    """
    n = len(model.languages)
    if not n:
        none = {"lang_found": F.lit(None).cast("string"), "probability": F.lit(0.0), "text_lang": F.lit(None).cast("string"), "accepted": F.lit(False)}
        return rows.withColumns(none)
    null = F.lit(None).cast("string")
    own = {"host": host, "domain": domain, "declared": declared, "suffix": suffix}
    # The rows travel in one column, so that no name of theirs can clash with one used here.
    named = rows.select(F.struct(*rows.columns).alias("_row"), text_of(text).alias("_body"), *[(v.cast("string") if v is not None else null).alias(f"_{k}") for k, v in own.items()])
    seen = with_text(named, model, text="_body")
    found = priors(seen.select("_lik", "_letters", *[F.col(f"_{k}").alias(k) for k in own]), model)
    joined = seen
    for side, key in ((found.hosts, "host"), (found.declared, "declared"), (found.suffixes, "suffix")):
        few = F.broadcast(side) if side.count() <= FEW_HOSTS else side
        joined = joined.join(few.withColumnRenamed(key, f"_{key}"), f"_{key}", "left")
    nothing = F.lit([0.0] * n)
    logs = _added(F.col("_lik"), F.coalesce("prior", F.lit(found.everyone)), F.coalesce("said", nothing), F.coalesce("told", nothing))
    names = F.lit(model.languages)
    best = F.array_max("_post")
    out = joined.withColumn("_post", _posterior(logs))
    accepted = (F.col("_letters") >= LETTERS) & (best >= LEAST)
    pick = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    out = out.withColumns({"accepted": accepted, "lang_found": F.when(accepted, pick(F.col("_post"))), "probability": best, "text_lang": F.when(F.col("_letters") > 0, pick(F.col("_lik")))})
    found = ["lang_found", "probability", "text_lang", "accepted"]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns if c not in found], *found)


def page_parts(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """pages with text (markup taken away), host, domain (its last two labels), declared (markup language), suffix."""
    bare = F.regexp_replace(text_of(html), r"(?is)<(script|style|nav)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract(text_of(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    said = F.nullif(F.lower(F.regexp_extract(text_of(html), r"(?i)<html[^>]*\blang=[\"']?([a-z]{2,8})\b", 1)), F.lit(""))
    return pages.withColumns({"text": bare, "host": host, "declared": said}).withColumns({"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)})
