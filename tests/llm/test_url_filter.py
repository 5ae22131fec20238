import random
from itertools import combinations

from pyspark.sql import functions as F

from tripmill.llm.queries import URL_RULES
from tripmill.llm.url_filter import host_of, judge_urls, matching_urls, mine_rules, path_of, tokens_of

PAGES = "page_id bigint, url string"
LABELS = "page_id bigint, bad boolean"
RULES = "tokens array<string>, confidence double, support double"


def no_rules(spark):
    return spark.createDataFrame([], RULES)


def test_host_and_path(spark):
    rows = [
        ("HTTP://A.Example.ORG/x/Y?q#f", "a.example.org", "/x/Y"),
        ("x://h", "h", ""),
        ("x://h?u=http://other/z", "h", ""),
        ("x://h#a/b", "h", ""),
        ("no scheme", "", ""),
        ("://", "", ""),
        ("://ÀB/p", "Àb", "/p"),
        ("", "", ""),
        (None, "", ""),
    ]
    df = spark.createDataFrame([r[:1] for r in rows], "u string")
    got = df.select(host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p")).collect()
    assert [(r.h, r.p) for r in got] == [r[1:] for r in rows]


def test_tokens(spark):
    df = spark.createDataFrame([("https://a.b.com/en/12/x.html?p=1&q=2#top",), (None,), ("plain",)], "u string")
    first, null, plain = [r.t for r in df.select(tokens_of(F.col("u")).alias("t")).collect()]
    assert set(first) == {
        "scheme=https", "host1=com", "host2=b", "host3=a", "path=en", "path=#", "path=x",
        "type=html", "parameter=p", "parameter=q", "fragment=top",
    }
    assert len(first) == len(set(first))
    assert null == plain == []


def test_given_rules(spark):
    urls = {
        "http://example.org/es/1": ("example.org/es/", "block"),
        "http://sub.example.org/es/1": ("example.org/es/", "block"),
        "http://notexample.org/es/1": ("org/", "allow"),
        "http://example.org/en/19": ("example.org/en/1", "block"),
        "http://example.org/en/2": ("org/", "allow"),
        "http://example.org": (None, "allow"),
        "http://x.com/fr/": ("com/fr/", "allow"),
        "http://com/de/a": ("com/de/", "block"),
        "http://x.com/DE/": (None, "allow"),
        "junk": (None, "allow"),
    }
    df = spark.createDataFrame(list(enumerate(urls)), PAGES)
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(df, no_rules(spark), URL_RULES).collect()}
    assert got == dict(enumerate(urls.values()))


def labelled(spark):
    pages = [(i, f"http://{'spam' if i % 5 == 0 else 'good'}{i % 3}.net/{'win' if i % 10 == 0 else 'page'}/{i}") for i in range(300)]
    bad = [(i, i % 10 == 0) for i in range(300)]
    return spark.createDataFrame(pages, PAGES), spark.createDataFrame(bad, LABELS), pages


def test_mined_rules_against_counting(spark):
    pages, labels, given = labelled(spark)
    rules = mine_rules(pages, labels, min_support=0.02, min_confidence=0.7).collect()
    tokens = {r.page_id: set(r.t) for r in pages.select("page_id", tokens_of(F.col("url")).alias("t")).collect()}
    assert rules
    for r in rules:
        covered = [i for i, t in tokens.items() if set(r.tokens) <= t]
        assert abs(sum(i % 10 == 0 for i in covered) / len(covered) - r.confidence) < 1e-9
        assert r.confidence >= 0.7 and r.support >= 0.02
        assert not any(set(o.tokens) < set(r.tokens) and o.confidence >= r.confidence for o in rules)
    verdicts = {r.page_id: r.verdict for r in judge_urls(pages, spark.createDataFrame(rules), []).collect()}
    assert verdicts == {i: "block" if i % 10 == 0 else "allow" for i, _ in given}


def all_rules(pages, least, min_confidence):
    """Rules by trying every combination of the tokens: ``pages`` are pairs of a set of tokens and whether the page is bad."""
    places = {}
    for i, (tokens, _) in enumerate(pages):
        for t in tokens:
            places.setdefault(t, set()).add(i)
    first = {}
    for t in sorted(places):
        first.setdefault(frozenset(places[t]), t)
    items = sorted(first.values())
    found = {}
    for size in range(1, len(items) + 1):
        for combination in combinations(items, size):
            on = [bad for tokens, bad in pages if tokens.issuperset(combination)]
            if sum(on) >= least and sum(on) / len(on) >= min_confidence:
                found[combination] = sum(on) / len(on)
    return {
        c: v for c, v in found.items() if not any(set(o) < set(c) and w >= v for o, w in found.items())
    }


def test_all_rules_are_found(spark):
    # Only pages with all five of a..e are mostly bad, so the rule is longer than any of its parts' rules; f is always with g.
    urls, bad = [], []
    for k in range(64):
        names = [x for i, x in enumerate("abcde") if k >> i & 1]
        for copy in range(6):
            urls.append("http://h.net/" + "/".join(names + (["f", "g"] if k >> 5 else [])))
            bad.append(len(names) == 5 or (copy == 0 and "a" in names))
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    labels = spark.createDataFrame(list(enumerate(bad)), LABELS)
    tokens = [set(r.t) for r in pages.orderBy("page_id").select(tokens_of(F.col("url")).alias("t")).collect()]
    lengths = set()
    for min_pages, min_confidence in ((1, 0.2), (6, 0.5), (12, 0.9), (13, 0.9)):
        rules = mine_rules(pages, labels, min_support=0.0, min_pages=min_pages, min_confidence=min_confidence).collect()
        got = {tuple(r.tokens): round(r.confidence, 9) for r in rules}
        want = all_rules(list(zip(tokens, bad, strict=True)), min_pages, min_confidence)
        assert len(got) == len(rules) and got == {c: round(v, 9) for c, v in want.items()}
        lengths |= {len(c) for c in got}
    assert max(lengths) == 5


def test_a_handful_of_pages_makes_no_rule(spark):
    pages, labels, _ = labelled(spark)
    some = pages.where("page_id < 100")
    assert mine_rules(some, labels, min_support=0.0, min_pages=11).collect() == []
    assert mine_rules(some, labels, min_support=0.11, min_pages=1).collect() == []
    assert mine_rules(some, labels, min_support=0.1, min_pages=10).collect()


def test_pages_not_learned_from(spark):
    # Bad pages have a telling combination nine times of ten; labels of one page in twenty are wrong, and the rest of the URL is noise.
    chance, pages, bad = random.Random(7), [], []
    for i in range(4000):
        worse = chance.random() < 0.25
        if worse and chance.random() < 0.9:
            host, name = "deals", "win"
        else:
            host, name = chance.choice([("deals", "page"), ("press", "win")])
        pages.append((i, f"http://{host}.net/{name}/{chance.choice('abcdefgh')}?{chance.choice('pqrs')}=1"))
        bad.append((i, worse != (chance.random() < 0.05)))
    df, labels = spark.createDataFrame(pages, PAGES), spark.createDataFrame(bad, LABELS)
    rules = mine_rules(df, labels.where("page_id % 2 = 0"))
    blocked = {r.page_id for r in judge_urls(df, rules).collect() if r.verdict == "block" and r.page_id % 2}
    unseen = [(i, b) for i, b in bad if i % 2]
    caught = sum(b for i, b in unseen if i in blocked)
    assert caught / len(blocked) > 0.85
    assert caught / sum(b for _, b in unseen) > 0.65


def test_index_against_all_rules(spark):
    pages, _, given = labelled(spark)
    rules = [(["path=win"],), (["host1=net", "path=page", "host2=spam1"],), (["path=win", "host2=good1"],), (["path=never"],), (["path=page", "path=never"],), ([],)]
    df = spark.createDataFrame(rules, "tokens array<string>")
    tokens = {r.url: set(r.t) for r in pages.select("url", tokens_of(F.col("url")).alias("t")).collect()}
    got = [r.url for r in matching_urls(pages, df).collect()]
    assert sorted(got) == sorted(u for u, t in tokens.items() if any(r[0] and set(r[0]) <= t for r in rules))


def test_awkward_rows(spark):
    rows = [(None, None), (None, "http://spam.net/"), (1, "http://spam.net/"), (1, "http://spam.net/"), (2, ""), (3, "http://x/" + "y/" * 5000)]
    df = spark.createDataFrame(rows, PAGES).withColumn("rule", F.lit("clash")).withColumn("token", F.lit("clash"))
    mined = spark.createDataFrame([(["host2=spam"], 1.0, 1.0)], RULES)
    got = sorted(((r.page_id, r.verdict) for r in judge_urls(df, mined).collect()), key=str)
    assert got == sorted([(None, "allow"), (None, "block"), (1, "block"), (1, "block"), (2, "allow"), (3, "allow")], key=str)
    empty = spark.createDataFrame([], PAGES)
    assert judge_urls(empty, mined).collect() == []
    labels = spark.createDataFrame([(1, None), (None, True), (3, False)], LABELS)
    assert mine_rules(df, labels).collect() == [] and mine_rules(empty, labels).collect() == []
