"""Fingerprints, scores, languages, near duplicates and the pipeline against brute force and on odd documents."""

import hashlib
import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opalgrid.llm import common, fingerprint, fitting, language, neardup, packing, quality, queries, toxicity


def plain(row):
    return {k: None if isinstance(v, float) and math.isnan(v) else v for k, v in row.asDict().items()}


# Fingerprints


def test_digest_query(spark, small, docs):
    texts = sorted(((d.doc_id, d.text) for d in docs.collect()), reverse=True)
    rows = {r.doc_id: r for r in queries.op1_quartile_digest(spark, small).collect()}
    own = dict(zip([k for k, _ in texts], fingerprint.codes([t for _, t in texts]), strict=True))
    assert len(rows) == len(texts)
    for i, (k, t) in enumerate(texts):
        after, x = texts[(i + 1) % len(texts)]
        h = len(t) // 2
        edited = t[: len(t) - h] + x[:h]
        assert rows[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[k].n_chars == len(t)
        assert rows[k].fingerprint == fingerprint.digest(own[k])
        assert rows[k].near_next == pytest.approx(fingerprint.likeness(own[k][None], own[after][None])[0])
        assert 0 <= rows[k].near_next <= 1 and rows[k].near_edited >= rows[k].near_next


def test_digest_properties():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh \n"), 3000))
    other = "".join(rng.choice(list("stuvwxyzé"), 3000))
    a, b, c, d = fingerprint.codes([text, text, text[:1500] + "!" + text[1500:], other])
    assert (a == b).all() and fingerprint.likeness(a[None], b[None])[0] == 1
    assert fingerprint.likeness(a[None], c[None])[0] > 0.8 > 0.65 > fingerprint.likeness(a[None], d[None])[0]
    assert fingerprint.likeness(a[None], d[None])[0] == fingerprint.likeness(d[None], a[None])[0]
    assert (fingerprint.digest_codes(fingerprint.digest(a)) == a).all()
    assert (fingerprint.codes(["ab", text, ""])[1] == a).all()  # no triplet crosses texts


def brute_digest(text):
    """The digest by its definition, byte by byte."""
    b, m = text.encode(), 0xFFFFFFFF
    counts = [0] * 128
    for i, j, seed in fingerprint.TRIPLETS:
        for k in range(len(b) - j):
            h = (b[k] * 0x9E3779B1 & m) ^ (b[k + i] * 0x85EBCA77 + seed & m)
            h = h * 0xC2B2AE3D & m
            h ^= h >> 15
            h = (h + b[k + j] * 0x27D4EB2F & m) * 0x165667B1 & m
            counts[h >> 25] += 1
    q = [sorted(counts)[k] for k in (31, 63, 95)]
    code = [sum(c > x for x in q) for c in counts]
    body = bytes(code[k] | code[k + 1] << 2 | code[k + 2] << 4 | code[k + 3] << 6 for k in range(0, 128, 4))
    most = max(1, q[2])
    return bytes([min(255, round(8 * math.log2(1 + len(b)))), (q[0] * 15 // most) << 4 | q[1] * 15 // most]).hex() + body.hex()


def test_digest_by_its_definition(spark, docs):
    rows = fingerprint.fingerprints(docs).select("text", "fingerprint").limit(60).collect()
    assert all(r.fingerprint == brute_digest(r.text or "") for r in rows)
    assert [fingerprint.digest(c) for c in fingerprint.codes(["", "a", "abcd", "héé" * 50])] == [brute_digest(t) for t in ("", "a", "abcd", "héé" * 50)]


def test_digest_odd(odd, none):
    rows = [plain(r) for r in fingerprint.audit(odd).collect()]
    assert len(rows) == 11 and fingerprint.audit(none).count() == 0
    ids = Counter(r["doc_id"] for r in rows)
    assert ids[3] == 2 and ids[None] == 2
    marked = fingerprint.fingerprints(odd)
    assert marked.select(F.count_distinct("fingerprint")).first()[0] <= 9 and marked.columns == odd.columns
    both = marked.withColumn("other", F.when(F.col("doc_id") == 3, F.col("fingerprint"))).withColumn("near", fingerprint.alike())
    assert {r.near for r in both.where("doc_id = 3").collect()} == {1.0}


# Scores


def score_table(spark, small, op, label):
    rows = op(spark, small).toPandas()
    labels = spark.read.parquet(f"{small}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert rows["score"].between(0, 1).all() and rows["score"].notna().all()
    import zlib

    assert (rows["held_out"] == rows["doc_id"].map(lambda k: zlib.crc32(str(k).encode()) % 5 == 0)).all()
    return rows.merge(labels, on="doc_id")


def test_quality_held_out(spark, small):
    rows = score_table(spark, "/root/testdata/sf0.01", queries.op6_additive_quality, "quality")
    held = rows[rows["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all()


def test_toxicity_held_out(spark, small):
    rows = score_table(spark, "/root/testdata/sf0.01", queries.op3_nearest_toxic, "toxic")
    held = rows[rows["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.95  # of 70, learned from 329
    assert held["predicted"][held["toxic"] == 1].mean() > 0.6 and held["predicted"][held["toxic"] == 0].mean() == 0
    assert (rows["predicted"] == (rows["score"] >= 0.5)).all()


def examples(n=900, seed=2, words=120):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdef"), 4)) for _ in range(words)]
    bad = ["vile", "rotten", "nasty"]
    y = (rng.random(n) < 0.3).astype(int)
    text = [" ".join([*rng.choice(words, 20), *(rng.choice(bad, 2) if k else [])]) for k in y]
    return pd.DataFrame({"id": np.arange(n), "text": text, "y": y})


def bagged(rows):
    got = list(toxicity.bags(rows["text"].tolist()))
    return pd.DataFrame({"id": rows["id"], "y": rows["y"], "h": [h.tobytes() for h, _ in got], "n": [n.astype(np.uint32).tobytes() for _, n in got]})


def brute_vectors(rows):
    """TF-IDF of whole texts over all words, raised by the likelihood ratio of word and label, as dictionaries."""
    split = [Counter("".join(c if ord(c) > 127 or c.isalnum() else " " for c in t.lower()).split()) for t in rows["text"]]
    n, df, pos = len(rows), Counter(w for b in split for w in b), Counter(w for b, y in zip(split, rows["y"], strict=True) for w in b if y)
    total = int(rows["y"].sum())

    def factor(w):
        d, p, g = df[w], pos[w], 0.0
        for seen, expected in ((p, d * total / n), (d - p, d * (n - total) / n), (total - p, (n - d) * total / n), (n - d - total + p, (n - d) * (n - total) / n)):
            g += 2 * seen * math.log(seen / expected) if seen else 0
        return math.log1p(n / d) * (1 + 30 * math.sqrt(max(0.0, g / 24 - 1))) if d else math.log1p(n)

    def vector(bag):
        w = {x: (1 + math.log(c)) * factor(x) for x, c in bag.items()}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {k: x / size for k, x in w.items()}

    return split, vector


def test_index_is_exact():
    """Block-max search gives the k nearest by cosine over all examples and all words."""
    rows = examples(2000, words=900)
    index = toxicity.fit(bagged(rows))
    assert len(index.blocks.begins) - 1 == toxicity.BLOCKS and (index.blocks.column < 0).sum() > 0
    split, vector = brute_vectors(rows)
    vectors = [vector(b) for b in split]
    for t in [*rows["text"][:40], "Vile, vile things", "abc unheard unheard2 fed", "nothing of it", ""]:
        mine = vector(Counter(t.lower().replace(",", " ").split()))
        every = sorted(((round(sum(w * v.get(k, 0) for k, w in mine.items()), 9), -i) for i, v in enumerate(vectors)), reverse=True)
        every = [(c, -i) for c, i in every if c > 1e-6][: toxicity.NEIGHBOURS]
        ((found, cosines),) = index.nearest([index.vector(b) for b in toxicity.bags([t])])
        assert np.allclose([c for c, _ in every], cosines, atol=3e-6)
        sure = [i for c, i in every if c > every[-1][0] + 1e-5]
        assert set(sure) <= set(index.ids[found].tolist())


def test_blocks_are_passed_over():
    """Examples of two languages lie apart, and a query's bound keeps it from the blocks of the other."""
    rng = np.random.default_rng(0)
    text = [" ".join(rng.choice([f"{'xy'[i % 2]}{k}" for k in range(400)], 30)) for i in range(3000)]
    index = toxicity.fit(bagged(pd.DataFrame({"id": range(3000), "text": text, "y": [i % 3 == 0 for i in range(3000)]}).astype({"y": int})))
    query = index.vector(next(toxicity.bags([text[0]])))
    c = index.blocks.column[query[0]]
    own = query[1][c >= 0] @ index.blocks.common_most[c[c >= 0]]
    assert (own == 0).sum() >= toxicity.BLOCKS // 3


def test_scores_follow_labels():
    rows = examples()
    index = toxicity.fit(bagged(rows))
    bad, good, none, long = (x[0] for x in toxicity.scores(index, ["abcd vile rotten", rows["text"][int(np.flatnonzero(rows["y"] == 0)[0])], "", "vile " + " ".join(f"z{i}" for i in range(5000))]))
    assert bad > 0.7 and good < 0.5 and none == pytest.approx(index.share)
    assert long < bad  # one word of a long text does not make it like a text of that word alone
    short, lengthy = (e[0]["cosine"] for _, e in toxicity.scores(index, ["vile", "vile " + " ".join(f"z{i}" for i in range(5000))]))
    assert lengthy < short / 2
    empty = toxicity.fit(bagged(rows.iloc[:0]))
    assert [x for x, _ in toxicity.scores(empty, ["anything", ""])] == [0.5, 0.5]


def test_additive_model():
    rng = np.random.default_rng(4)
    text = [("Word " * 30).strip() if k else "!!! $$$ " * 20 for k in rng.random(400) < 0.7]
    rows = pd.DataFrame({"text": text, "y": [int(t.startswith("Word")) for t in text]})
    model = quality.fit(rows)
    x = quality.features(text)
    assert ((model.scores(x) >= 0.3) == rows["y"]).all()
    by_hand = np.full(len(x), model.base)
    for j in range(x.shape[1]):
        by_hand += [model.tables[j][np.searchsorted(model.edges[j], v, side="right")] for v in x[:, j]]
    for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
        by_hand += [t[np.searchsorted(model.pair_edges[i], a, side="right"), np.searchsorted(model.pair_edges[j], b, side="right")] for a, b in zip(x[:, i], x[:, j], strict=True)]
    assert np.allclose(by_hand, model.logits(x))
    assert (quality.fit(rows.iloc[:0]).scores(quality.features(["", "a"])) == 0.5).all()


def test_scores_odd(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (None, 1, 1), (8, None, None), (9, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for docs, n in ((odd, 11), (none, 0)):
        assert toxicity.scored(docs, toxicity.learn(docs, labels)).where("score BETWEEN 0 AND 1").count() == n
        assert quality.scored(docs, quality.learn(docs, labels)).where("score BETWEEN 0 AND 1").count() == n
    assert fitting.sample(odd, labels, "toxic", 100).where("id = 3").count() <= 1


# Languages


def test_language_query(spark, small, docs):
    rows = queries.op4_language_evidence(spark, small)
    truth = {d.doc_id: d.lang for d in docs.collect()}
    found = rows.where("doc_id IS NOT NULL").collect()
    assert len(found) == len(truth) and np.mean([truth[r.doc_id] == r.lang_found for r in found]) > 0.97
    pages = rows.where("page_id IS NOT NULL").collect()
    assert len(pages) == spark.read.parquet(f"{small}/pages.parquet").count()
    assert np.mean([r.declared == r.lang_found for r in pages]) > 0.95


def test_language_fusion(spark, docs):
    """Without letters of its own a text takes its host's language only if it is accepted; declarations tip the scales."""
    model = language.learn(docs)
    rows = spark.createDataFrame([*[(f"h{i}", "le la les des une que pour dans", "fr", "a.fr") for i in range(40)], ("x", "12 34", None, "a.fr"), ("y", "la", "es", "b.es"), ("z", "la", None, "a.fr")], "k string, text string, said string, site string")
    out = {r.k: r for r in language.identified(rows, model, host=F.col("site"), domain=F.col("site"), declared=F.col("said"), suffix=F.substring_index("site", ".", -1)).collect()}
    assert out["h1"].lang_found == "fr" and out["z"].lang_found == "fr"
    assert not out["x"].accepted and out["x"].lang_found is None
    assert all(0 <= r.probability <= 1 + 1e-9 for r in out.values())


def test_language_odd(odd, none, docs):
    model = language.learn(docs)
    out = language.identified(odd, model, host=F.col("source"))
    found = ["lang_found", "probability", "text_lang", "accepted"]
    assert out.columns == [*[c for c in odd.columns if c not in found], *found] and out.count() == 11
    assert dict(out.dtypes)["probability"] == "double" and out.where("lang_found = 'lang_found'").count() == 0
    assert {r.accepted for r in out.where("text IS NULL OR trim(text) = ''").collect()} == {False}
    assert out.where("host <> 'host'").count() == 0
    assert language.identified(none, model, host=F.col("source")).count() == 0
    assert language.identified(odd, language.learn(none)).where("accepted").count() == 0


def test_texts_are_looked_at_once_a_pass(spark, docs):
    """Each task of a pass over the texts needs one Python process, not one for a condition and one for the result."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text", "source")
    model = language.learn(docs)
    seen = language.with_text(rows, model)
    kept = language.identified(rows, model, host=F.col("source")).where("accepted").select("_row.*")
    for df in (kept, seen.where("_letters >= 2").select("_lik")):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_symbols_are_no_letters(spark):
    model = language.Model(["de", "en"], np.zeros((language.BUCKETS, 2), np.float32), language._letters())
    rows = spark.createDataFrame([("\U0001f600\U0001f600\U0001f600",), ("\u65e5\u672c",), ("12 :-) 34",)], "text string")
    found = {r.text: r.accepted for r in language.identified(rows, model).collect()}
    assert list(found.values()) == [False, True, False]


def test_language_on_documents_that_were_not_learned_from(spark):
    """Learned from 300 of the documents, right on the others; a whole primary tag is read from markup."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    h = F.xxhash64("doc_id", F.length(common.text_of()))
    last = sorted(r[0] for r in docs.where("length(text) > 0").select(h).distinct().collect())[299]
    others = language.identified(docs, language.learn(docs, most=300), host=F.col("source")).where(h > last).collect()
    right = np.mean([r.lang_found == r.lang for r in others if r.accepted])
    assert len(others) > 500 and right > 0.99
    page = spark.createDataFrame([('<HTML lang="fil-PH"><p>x</p>', "http://a.b.example.ph/c")], "html string, url string")
    (p,) = language.page_parts(page).collect()
    assert (p.declared, p.host, p.domain, p.suffix) == ("fil", "a.b.example.ph", "example.ph", "ph")


def test_evidence_is_multiplied(spark):
    """Posteriors by hand: text, declaration and suffix, times a host's prior that leans on its domain's and everyone's."""
    rng = np.random.default_rng(3)
    fit_on = pd.DataFrame({"text": ["der die das und", "the of and to"], "lang": ["de", "en"]})
    model = language.fit(fit_on)
    words = "der die das und the of and to haus house".split()
    rows = [(i, " ".join(rng.choice(words, 4)), f"h{i % 7}.d{i % 3}.x", f"d{i % 3}.x", ["de", "en", None][i % 3], ["x", None][i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, domain string, declared string, suffix string")
    found = {r.doc_id: r for r in language.identified(df, model, **{c: F.col(c) for c in ("host", "domain", "declared", "suffix")}).collect()}
    lik, _ = language.likelihoods(model, [r[1] for r in rows])
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    alone = np.array([soft(x) for x in lik])
    everyone = alone.sum(axis=0) + 1
    everyone /= everyone.sum()

    def sums(column):
        out = defaultdict(lambda: np.zeros(2))
        for r, p in zip(rows, alone, strict=True):
            if r[column] is not None:
                out[r[column]] += p
        return out

    hosts, domains, declared, suffixes = (sums(c) for c in (2, 3, 4, 5))
    lean = lambda s, on: (s + language.LEAN * on) / (s.sum() + language.LEAN)
    said = lambda table, v: np.log((table[v] + 0.5) / (sum(table.values()) + 0.5 * len(table))) if v is not None else 0.0
    for r, x in zip(rows, lik, strict=True):
        p = soft(x + np.log(lean(hosts[r[2]], lean(domains[r[3]], everyone))) + said(declared, r[4]) + said(suffixes, r[5]))
        assert found[r[0]].probability == pytest.approx(p.max(), rel=1e-6)
        assert found[r[0]].lang_found == model.languages[int(p.argmax())]


def test_sample_is_the_same_at_each_run(spark):
    docs = spark.createDataFrame([(k, f"text {k} {j}") for k in range(50) for j in range(3)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(3, 0), (4, 1)], "doc_id long, toxic int")
    first = {tuple(r) for r in fitting.sample(docs, labels, "toxic", 20).select("id", "text", "y").collect()}
    again = {tuple(r) for r in fitting.sample(docs.repartition(7), labels.repartition(3), "toxic", 20).select("id", "text", "y").collect()}
    assert first == again and len(first) == 20


# Near duplicates


def brute_classes(docs):
    """(doc_id, class) by all pairs of different texts that share a shingle: alike by TF-IDF weights or by plain counts."""
    rows = [(-(2**63) if d.doc_id is None else d.doc_id, d.text or "") for d in docs.collect()]
    texts = sorted({t for _, t in rows})
    bags = []
    for t in texts:
        w = t.lower().split()
        n = min(5, len(w))
        bags.append(Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else Counter())
    df = Counter(x for b in bags for x in b)
    idf = {x: math.log1p(len(texts) / n) for x, n in df.items()}
    holders = defaultdict(list)
    for i, b in enumerate(bags):
        for x in b:
            holders[x].append(i)
    top = list(range(len(texts)))

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    def alike(a, b, weight):
        both = {x: weight(x) for x in a.keys() | b.keys()}
        return sum(min(a[x], b[x]) * w for x, w in both.items()) / sum(max(a[x], b[x]) * w for x, w in both.items()) >= 0.8

    for i, b in enumerate(bags):
        for j in {j for x in b for j in holders[x] if j < i}:
            if alike(b, bags[j], lambda _: 1.0) or alike(b, bags[j], idf.__getitem__):
                top[find(i)] = find(j)
    of = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for k, t in rows:
        least[of[t]] = min(least.get(of[t], k), k)
    return Counter((k, least[of[t]]) for k, t in rows)


def real(x):
    return -(2**63) if x is None else x


def test_near_duplicates(spark, docs):
    """The given documents, with edited copies of some: chains of near copies end in one class."""
    base = [d for d in docs.limit(60).collect() if d.text and len(d.text.split()) > 150]
    more = []
    for k, d in enumerate(base[:12]):
        w = d.text.split()
        for c in range(4):
            w = [*w[: 20 + 25 * c], f"edit{k}{c}", *w[21 + 25 * c :]]
            more.append((100_000 + 10 * k + c, " ".join(w)))
    more += [(200_000, base[0].text), (200_001, base[0].text.upper()), (200_002, base[1].text + " tail of words")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = Counter((real(r.doc_id), real(r.class_id)) for r in neardup.classes(rows).collect())
    assert found == brute_classes(rows)


def test_near_duplicates_odd(odd, none):
    rows = neardup.classes(odd)
    assert Counter((real(r.doc_id), real(r.class_id)) for r in rows.collect()) == brute_classes(odd)
    assert neardup.classes(none).count() == 0 and neardup.deduplicated(none).count() == 0
    kept = neardup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.where("_key <> '_key' OR _node <> '_node'").count() == 0
    assert kept.count() == rows.select("_label").distinct().count()


def test_unlike_texts_with_one_key_stay_apart(spark):
    texts = [" ".join(f"{w}{i}" for i in range(40)) for w in "abcd"]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]), (None, texts[0]), (9, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.text for r in neardup.deduplicated(df).collect()) == Counter(texts)
    sizes = Counter((r.doc_id, r.class_size) for r in neardup.classes(df).collect())
    assert sizes == {(None, 2): 2, (None, 1): 1, (5, 2): 3, (9, 2): 1}


def test_near_copies_of_a_text_that_many_rows_share(spark):
    words = [f"w{i}" for i in range(100)]
    swapped = lambda k, *at: " ".join(f"edit{k}x{i}" if i in at else w for i, w in enumerate(words))
    others = [(1000 + i, " ".join(f"o{i}x{j}" for j in range(60))) for i in range(200)]
    copies = [(i, " ".join(words)) for i in range(100)]
    near = [(300 + k, swapped(k, 5 + k, 60 + k)) for k in range(30)]  # plain similarity to the text 0.81, to each other less
    rows = spark.createDataFrame(copies + near + others, "doc_id long, text string")
    found = {r.doc_id: (r.class_id, r.class_size) for r in neardup.classes(rows).collect()}
    joined = [k for k, _ in near if found[k][0] == 0]
    assert len(joined) >= 28  # a pair at 0.81 shares no band with probability 0.001
    assert {found[k] for k, _ in copies} == {(0, 100 + len(joined))}
    assert all(found[k] == (k, 1) for k, _ in others)


def test_classes_of_the_given_documents(spark, docs):
    assert Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect()) == brute_classes(docs)


def test_links_that_no_centre_shows(spark):
    """Versions of one text, each changed from the one before: the ends are unlike the middle, yet all are one class."""
    words, rows = [f"w{i}" for i in range(120)], []
    for k in range(24):
        rows.append((k, " ".join(words)))
        words[5 * k] = f"v{k}"
    for k in range(30):  # and copies that are alike to the first version only, or to none
        own = [f"w{i}" for i in range(120)]
        for j in range(2 + k % 5):
            own[(11 * k + 23 * j) % 120] = f"x{k}y{j}"
        rows.append((100 + k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect())
    assert found == brute_classes(docs)
    assert len({c for k, c in found if k < 24}) == 1 < len({c for _, c in found})


def test_document_frequencies_are_exact(spark):
    """Copies count once; a shingle that many texts hold, in several batches, is counted over all of them."""
    texts = [f"a b c d e {i} x{i} y{i} z{i}" for i in range(300)] + [f"p q r s t {i}" for i in range(4)] + ["p q r s t 1"] * 9 + ["", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = neardup._texts(docs, "text", "doc_id")
    batches = neardup._batches(neardup._once(rows, rows.groupBy("_node").agg(F.count("*").alias("n"))))
    assert batches.count() > 1
    signed = {bytes(r["_node"]): r for r in neardup._signed(batches, neardup._frequencies(batches), 305).collect()}
    assert len(signed) == 305
    every = [t or "" for t in texts]
    df = Counter(x for t in set(every) for h, _ in neardup.sets([t]) for x in h.tolist())
    for t in every:
        r = signed[hashlib.md5(t.encode()).digest()]
        (h, _), = neardup.sets([t])
        assert neardup.restored(r.df).tolist() == [df[x] for x in h.tolist()]
        assert len(r.bands) == (0 if not t else 24)  # all hold a shingle that others hold too


def test_samples_follow_similarity():
    rng = np.random.default_rng(0)
    for share in (0.4, 0.8):
        seen, true = [], []
        for _ in range(60):
            h = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
            w = rng.choice([1.0, 2, 5.3, 10.6], 400).astype(np.float32)
            m = rng.random(400) < share
            h2 = np.sort(np.concatenate([h[m], rng.integers(0, 2**63, int((~m).sum())).astype(np.uint64)]))
            kept = dict(zip(h, w, strict=True))
            w2 = np.array([kept.get(x, 5.3) * (1 if rng.random() < 0.9 else 2) for x in h2], np.float32)
            seen.append((neardup.samples(h, w)[0] == neardup.samples(h2, w2)[0]).mean())
            true.append(neardup.similarity((h, w), (h2, w2)))
        assert abs(np.mean(seen) - np.mean(true)) < 0.04


# Pipeline


def test_pipeline(spark, small, docs):
    kept, ids = docs, {d.doc_id for d in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.stored(stage(spark, kept, small), "test")
        assert kept.columns == docs.columns, name
        now = {d.doc_id for d in kept.collect()}
        assert now <= ids
        if name == "quality classifier":
            assert np.mean([labels[k] for k in ids - now if k in labels]) < 0.2
        if name == "MinHash near-dedup":
            assert set(brute_classes(kept).values()) == {1}
        ids = now
    last = corpus_pipeline.STAGES[-1][1](spark, kept, small).collect()
    assert {r.doc_id for r in last} == ids
    again = corpus_pipeline.run(spark, small).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(again) == key(last)


def test_pipeline_odd(spark, odd, none, small):
    for docs in (odd, none):
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = common.stored(stage(spark, kept, small), "odd")
            assert kept.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, kept, small).count() >= kept.count()
    assert packing.CAPACITY == 4096


def templates(n, seed=4, words=120, pool=30, edits=5):
    """Texts of one template, each with a few edits of a common pool."""
    rng = np.random.default_rng(seed)
    base, at = [f"w{i}" for i in range(words)], [4 * k + 1 for k in range(pool)]
    out = []
    for _ in range(n):
        own = list(base)
        for k in rng.choice(pool, edits, replace=False):
            own[at[k]] = f"edit{k}"
        out.append(" ".join(own))
    return out


def test_templates_with_pooled_edits_are_not_compared_in_pairs(spark, monkeypatch):
    """Far fewer pairs are compared than there are, and the classes are those of all pairs."""
    asked, compared = [], neardup._compared

    def counting(pairs, *args):
        out = compared(pairs, *args)
        asked.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_compared", counting)
    sums = {}
    for n in (100, 400):
        asked.clear()
        texts = templates(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = neardup.classes(docs).select("doc_id", "class_id", "class_size", "links").collect()
        sums[n] = sum(asked)
        of_class = {}
        for r in found:
            of_class.setdefault(r.class_id, set()).add(texts[r.doc_id])
        assert all((r.links > 0) == (len(of_class[r.class_id]) > 1) for r in found)
        if n == 100:
            assert Counter((r.doc_id, r.class_id) for r in found) == brute_classes(docs)
    assert sums[400] < 400 * 399 / 2 / 4


def test_links_among_many_texts_of_one_template(spark):
    """Texts that are alike to one other each, among many that are nearly alike and so share their buckets: no link is lost."""
    places, rows = np.random.default_rng(1).permutation(list(combinations(range(35), 3))), []
    for k in range(400):  # two texts are changed at the same three places each, so they are alike (0.84); others are not (0.8 or less)
        own = [f"w{i}" for i in range(179)]
        for i in places[k // 2]:
            own[5 * i + 4] = f"own{k}x{i}"
        rows.append((k, " ".join(own)))
    found = neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id, r.links) for r in found} == {(k, k - k % 2, 1) for k in range(400)}


def test_slices_of_pairs_give_the_same_classes(spark, monkeypatch):
    """However many slices the pairs are taken by, and however the holders of a shingle are dealt."""
    docs = spark.createDataFrame(list(enumerate(templates(100))), "doc_id long, text string")
    monkeypatch.setattr(neardup, "EACH", 20)
    monkeypatch.setattr(neardup, "HOLDERS", 5)
    assert Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect()) == brute_classes(docs)


def test_pairs_without_enough_left_are_not_compared(spark, monkeypatch):
    """Texts of a template with edits of their own: all links are found, though few pairs are compared after the centres'."""
    seen, asked = [], neardup._may_be_alike

    def counting(*args):
        out = neardup.cut(asked(*args))
        seen.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_may_be_alike", counting)
    rng, base, edits, rows = np.random.default_rng(5), [f"w{i}" for i in range(150)], [], []
    for k in range(100):
        own = {int(i): f"own{k}x{i}" for i in rng.choice(30, rng.integers(1, 7), replace=False) * 5 + 2}
        if k % 10 == 9:  # like the text before, but for one place
            own = {**edits[-1], int(rng.integers(150)): f"own{k}"}
        edits.append(own)
        rows.append((k, " ".join(own.get(i, w) for i, w in enumerate(base))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect()) == brute_classes(docs)
    assert sum(seen) < 400
