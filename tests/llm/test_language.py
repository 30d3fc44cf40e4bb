import math
import random

import pyarrow as pa
import pytest

from tests.llm.helpers import sample_table
from tillwright.llm import language


def test_trigrams_stay_inside_texts():
    texts = ["Ab c", None, "", "123 !?", "abé", "a", "xyz" * 3]
    buckets, first = language.trigrams(pa.array(texts))
    for n, text in enumerate(texts):
        data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
        own = [int.from_bytes(data[i : i + 3], "big") for i in range(len(data) - 2)]
        want = [(g * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for g in own if g != 0x202020]
        assert buckets[first[n] : first[n + 1]].tolist() == want


@pytest.fixture(scope="module")
def model(spark):
    return language.train(sample_table(spark, "documents"))


def identify(docs, model, rows, **options):
    found = language.identify(docs(rows), model, "doc_id", "text", declared="lang", host="source", **options)
    return {r["id"]: r for r in found.collect()}


def test_held_out_accuracy(spark, model):
    """The model of one table on another one, from the text alone, and with all evidence."""
    other = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for evidence, least in (({}, 0.97), ({"declared": "lang", "host": "source"}, 0.98)):
        found = language.identify(other, model, "doc_id", "text", **evidence)
        joined = found.join(other, found["id"] == other["doc_id"]).selectExpr("avg(int(language = lang)) AS right", "avg(int(keep)) AS kept").first()
        assert joined["right"] > least and joined["kept"] > least


def test_matches_plain_bayes(docs, model):
    rng = random.Random(1)
    samples = {"en": "the and that thing ering ", "de": "einheit der und schlich ", "fr": "les eaux que mention ", "es": "ción que los mente "}
    rows = []
    for n in range(60):
        lang = rng.choice(list(samples))
        rows.append((n, samples[lang] * rng.randrange(4), rng.choice([lang, lang, "xx", None, "EN"]), rng.choice(["h1", "h2", None])))
    got = identify(docs, model, rows)
    names, votes, heard = model.languages, {}, {}
    for doc_id, text, declared, host in rows:
        buckets, _ = language.trigrams(pa.array([text]))
        heard[doc_id] = [int(row[buckets].sum()) for row in model.table]
        votes[doc_id] = max(range(len(names)), key=lambda i: (heard[doc_id][i], -i)) if len(buckets) else None
    def share(own, parent, strength):
        return [(own[i] + strength * parent[i]) / (sum(own) + strength) for i in range(len(names))]
    def tally(host=None):
        mine = [votes[d] for d, _, _, h in rows if (host is None or (h or "") == host) and votes[d] is not None]
        return [mine.count(i) for i in range(len(names))]
    corpus = share(tally(), [1 / len(names)] * len(names), len(names))
    suffix = share(tally(), corpus, 20)
    for doc_id, text, declared, host in rows:
        said = (declared or "").lower()
        logs = []
        for i in range(len(names)):
            x = heard[doc_id][i] / language.UNIT * 0.25 + math.log(share(tally(host or ""), suffix, 20)[i])
            if said in names:
                counts = [sum((d or "").lower() == n and votes[q] == i for q, _, d, _ in rows) for n in names]
                x += math.log((counts[names.index(said)] + 0.5) / (sum(counts) + 0.5 * len(names)))
            logs.append(x)
        n_grams = len(language.trigrams(pa.array([text]))[0])
        logs.append(n_grams * -16 * math.log(2) * 0.25 + math.log(0.001) - math.log(len(names)))
        best = max(logs)
        confidence = 1 / sum(math.exp(x - best) for x in logs)
        assert got[doc_id]["language"] == [*names, "und"][logs.index(best)]
        assert got[doc_id]["confidence"] == pytest.approx(confidence, abs=2e-6)
        assert got[doc_id]["keep"] == (n_grams > 0 and logs.index(best) < len(names) and got[doc_id]["confidence"] >= 0.5)


def test_priors_and_declarations_decide_short_texts(docs, model):
    rows = [(n, "einheit der und die schlich " * 5, "de", "german") for n in range(50)]
    rows += [(100 + n, "the and that thing ering is " * 5, "en", "english") for n in range(50)]
    rows += [(200, "la", "de", "german"), (201, "la", "en", "english"), (202, "12", "de", "german"), (203, None, "de", "german")]
    got = identify(docs, model, rows)
    assert got[200]["language"] == "de" and got[201]["language"] == "en"
    assert not got[202]["keep"] and not got[203]["keep"] and got[0]["keep"] and got[100]["keep"]


def test_noise_is_unknown(docs, model):
    rng = random.Random(5)
    noise = "".join(rng.choice("qxzjkvw") for _ in range(600))
    got = identify(docs, model, [(0, noise, None, None), (1, "the thing and the ering that is", "en", "a")])
    assert got[0]["language"] == "und" and not got[0]["keep"] and got[1]["keep"]


def test_empty_table_repeats_and_no_labels(spark, docs, model):
    assert identify(docs, model, []) == {}
    twice = language.identify(docs([(1, "the end"), (1, "the end"), (None, "the end")]), model, "doc_id", "text")
    assert twice.count() == 3
    none = language.train(docs([(1, "x", None, None)]))
    got = identify(docs, none, [(1, "some text")])
    assert got[1]["language"] == "und" and not got[1]["keep"]


def test_page_evidence(spark, model):
    html = '<html class="x" lang="de-AT"><head><style>b{}</style></head><!-- c --><p>Hallo <b>du</b></p><script>x("</p>")</script>'
    pages = spark.createDataFrame([(1, "http://u@www.Example.de:80/x?y", html), (2, None, None)], "page_id bigint, url string, html string")
    one, two = sorted(language.page_evidence(pages).collect())
    assert (one["text"].split(), one["declared"], one["host"], one["suffix"]) == (["Hallo", "du"], "de", "www.Example.de", "de")
    assert two["text"] is None
    found = language.identify(language.page_evidence(pages), model, "id", "text", "declared", "host", "suffix")
    assert found.count() == 2
