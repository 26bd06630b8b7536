"""Url rules and benchmark windows against plain Python; odd rows."""

import random
import re

from instrel.llm import op06_url_filters as urls
from instrel.llm import op10_decontamination as op
from instrel.llm.queries import URL_PATTERNS, URL_RULES


def verdict(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else None
    if rest is None:
        return "", "", None, "allow"
    host = re.match(r"[^/?#]*", rest)[0]
    after = rest[len(host):]
    path = re.match(r"[^?#]*", after)[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
            if (low == h or low.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, v = max(fits, key=lambda f: len(f[0]))
        return low, path, rule, v
    text = f"{path} {after[len(path):]}"
    bad = re.search(r"[?&]page=[0-9]+", text) or re.search(r"/(login|cart)([/.]|$)", path) or path.endswith(".zip")
    return low, path, None, "block" if bad else "allow"


def test_urls(spark):
    rng = random.Random(4)
    parts = ["http", "://", "a.", "example", ".net", ".com", ".org", "net", "/en/", "/de/", "/fr/", "?page=2", "&page=x", "#t", "/login", "/cart.html", "x.zip", "EXAMPLE", "é", " "]
    given = [None, "", "no scheme", "://", "http://net", "http://net/", "https://m.Example.NET/en/1", "http://notnet/", "http://example.com:80/de/", "http://a/?u=http://b.net/",
             *("http://" + "".join(rng.choice(parts) for _ in range(rng.randrange(8))) for _ in range(300)), "http://x.org/fr/" + "y" * 100000]
    rows = list(enumerate(given)) + [(0, None), (None, "http://net/"), (5, "http://net/")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, rule string")
    out = urls.judge_with_sites(frame, URL_RULES, URL_PATTERNS).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in out) == sorted(
        (str(i), h, p, str(rule), v) for i, u in rows for h, p, rule, v in [verdict(u)])
    assert urls.judge_with_sites(spark.createDataFrame([], "page_id long, url string"), URL_RULES, URL_PATTERNS).count() == 0


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, other in items:
        x = words(other)
        n = min(10, len(x))
        grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
        for s in range(len(w) - n + 1) if n else ():
            if tuple(w[s:s + n]) in grams:
                hit.update(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_contamination(spark):
    rng = random.Random(6)
    vocabulary = ["ab", "cd", "Éf", "g1", "HI"]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, item(rng.choice([1, 3, 4, 9, 10, 11, 30]) if i > 20 else 14)) for i in range(40)]
    items = [(i, t) for i, t in items if len(words(t)) > 3] + [(90, None), (91, ""), (92, "..."), (93, items[3][1]), (None, "ab cd")]
    valid = [(i, t) for i, t in items if i is not None]
    texts = []
    for n in range(60):
        parts = [item(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            other = words(rng.choice(valid)[1])
            cut = rng.randrange(3)
            parts += [", ".join(other[cut:]), item(rng.randrange(6))]
        texts.append(" ".join(parts))
    rows = list(enumerate(texts)) + [(70, None), (71, ""), (72, items[0][1].upper()), (72, items[0][1].upper()), (None, items[1][1]), (73, "zz " * 60000 + items[2][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    out = op.contamination(docs, bench).collect()
    want = [(str(i), *brute(t, valid)) for i, t in rows]
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items) for r in out) == sorted(want)
    assert any(w[2] for w in want) and all(r.contaminated == (r.n_hit > 0) for r in out)
    clean = op.clean_rows(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(w[0] for w in want if not w[2])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert op.contamination(docs, empty).where("contaminated").count() == 0
    assert op.contamination(spark.createDataFrame([], "doc_id long, text string"), bench).count() == 0


def test_repeats_of_an_item_are_one_context(spark):
    texts = [(i, "same " * 400 + "end") for i in range(4)]
    items = [(i, "same " * 100) for i in range(2)]
    docs = spark.createDataFrame([(*t, "x", 1, 2) for t in texts], "doc_id long, text string, bad_id string, bad_hash int, row int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert op.shared_spans(docs, bench).count() <= 4 * 400 * 2 * 11
    out = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in op.contamination(docs, bench).collect()}
    assert out == {i: (401, 400, ["0", "1"]) for i, _ in texts}
    clean = op.clean_rows(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 0
