"""Many-pattern search against plain string search."""

import random
import re

from pyspark.sql import functions as F

from prospectra.functions.patterns import found_patterns, pattern_hits, replace_longest
from prospectra.operators.patterns import patterns_in, pattern_sets, places_in
from prospectra.plans import evidence, people

WORDS = ["a", "ab", "abc", "bc", "é", "ana", "an", "owner", "co-owner", "jo", "jo lee", ".", "x_1", "🐶a"]


def places(text, patterns):
    out = []
    for k, p in enumerate(patterns or []):
        at = text.find(p) if p and text else -1
        while at >= 0:
            end = at + len(p)
            out.append((k, at, at > 0 and bool(re.match(r"[A-Za-z0-9_]", text[at - 1])), end < len(text) and bool(re.match(r"[A-Za-z0-9_]", text[end]))))
            at = text.find(p, at + 1)
    return sorted(out)


def rows(seed, count=120):
    pick = random.Random(seed)
    return [("".join(pick.choice([*WORDS, " ", " ", "-"]) for _ in range(pick.randint(0, 30))), [pick.choice([*WORDS, "", None]) for _ in range(pick.randint(0, 6))]) for _ in range(count)] \
        + [(None, ["a"]), ("abc", None), ("", ["a"]), ("aaaa", ["aa", "aa", "a"])]


def test_hits_are_all_places(spark):
    own = rows(1)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(own)], "i int, t string, p array<string>").repartition(3)
    got = df.select("i", pattern_hits(F.col("t"), F.col("p")).alias("h"), found_patterns(F.col("t"), F.col("p")).alias("f")).collect()
    for r in got:
        text, patterns = own[r.i]
        assert sorted(map(tuple, r.h)) == places(text, patterns)
        assert r.f == list(dict.fromkeys(p for p in patterns or [] if p and text and p in text))


def test_places_by_key(spark):
    pick = random.Random(2)
    texts = [(pick.choice([1, 1, 1, 2, None]), t) for t, _ in rows(3)]
    sets = [(pick.choice([1, 2, 3, None]), p) for p in WORDS * 3] + [(1, None), (2, "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(texts)], "i int, k int, t string")
    patterns = spark.createDataFrame(sets, "k int, p string")
    own = {k: sorted({p for j, p in sets if j == k and p}) for k in (1, 2)}
    want = sorted((i, own[k][n], at, not left and not right) for i, (k, t) in enumerate(texts) if k in own and t for n, at, left, right in places(t, own[k]))
    for limit in (2, 10_000):
        assert sorted(tuple(r) for r in places_in(df, patterns, ["k"], "t", "p", limit).select("i", "p", "start", "whole").collect()) == want
        assert sorted(tuple(r) for r in patterns_in(df, patterns, ["k"], "t", "p", limit).select("i", "p").collect()) == sorted({w[:2] for w in want})
    assert pattern_sets(patterns, ["k"], "p", 3).filter("k = 1").count() > 1


def test_replacing_goes_longest_first(spark):
    names = {"abc": "<1>", "bcde": "<2>", "a": "<3>", "de": "<4>", "": "no"}
    texts = ["abcde", "abcabc bcde", "xaxdex", "", None, "bcdebcde", "aaa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", replace_longest(F.col("t"), names).alias("v")).collect()}
    for i, text in enumerate(texts):
        for key in sorted((k for k in names if k), key=len, reverse=True):
            text = None if text is None else text.replace(key, names[key])
        assert got[i] == text
    assert df.select(replace_longest(F.col("t"), {}).alias("v")).collect() == df.select(F.col("t").alias("v")).collect()


def near(title, name, page, reach):
    """The rule in regular expressions."""
    whole = lambda p: rf"(?<![A-Za-z0-9_]){re.escape(p)}(?![A-Za-z0-9_])"

    def beside(who):
        return any(re.search(whole(title), page[max(0, m.start() - reach):m.end() + reach]) for m in re.finditer(whole(who), page))

    first = name.split(" ")[0]
    return bool(title and first and title in page and first in page and (beside(first) or (name != first and beside(name))))


def test_titles_near_names(spark):
    pick = random.Random(4)
    own = []
    for _ in range(250):
        page = " ".join(pick.choice(["owner", "co-owner", "founder", "jo", "jo lee", "ann", "annette", "x", "dogs", "and so"]) for _ in range(pick.randint(0, 25)))
        own.append((pick.choice(["owner", "founder", ""]), pick.choice(["jo", "jo lee", "ann", "ann x", ""]), page))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(own)], "i int, t string, n string, p string")
    for reach in (6, 20):
        got = {r.i: r.v for r in df.select("i", evidence.title_near_name(F.col("t"), F.col("n"), F.col("p"), reach).alias("v")).collect()}
        assert [got[i] for i in range(len(own))] == [near(*r, reach) for r in own]


def test_claims_in_several_arrays(spark, monkeypatch):
    monkeypatch.setattr(evidence, "MAX_CLAIMS", 3)
    contacts = [(f"jo{i}", "owner" if i % 2 else "boss", f"jo{i} said yes ... and more" if i % 3 else "never said") for i in range(20)]
    research = spark.createDataFrame([(1, [(*c, "", True) for c in contacts], None)], "business_id long, contacts array<struct<name:string,title:string,evidence:string,email:string,is_decision_maker:boolean>>, angle_evidence string")
    pages = spark.createDataFrame([(1, " . ".join(f"owner jo{i} said yes" for i in range(20))), (1, "and more"), (1, None), (2, "owner jo1")], "business_id long, text string")
    got = {(r.idx, r.kind): r.proven for r in evidence.prove(evidence.claims_of(research), pages).collect()}
    assert got == {**{(i, "title"): i % 2 == 1 for i in range(20)}, **{(i, "quote"): i % 3 != 0 for i in range(20)}}


def test_last_names_meet_addresses_that_hold_them(spark):
    mails = spark.createDataFrame([(1, "Pat.Lee@x.com"), (1, "plee2@x.com"), (1, "info@x.com"), (2, "lee@x.com"), (None, "lee@x.com")], "business_id long, email string")
    named = spark.createDataFrame([(1, "pat lee", "lee"), (1, "ann ee", "ee"), (2, "jo kline", "kline")], "business_id long, name_key string, last_name string")
    assert sorted(map(tuple, people.address_index(mails, named).select("business_id", "last_name", "local").collect())) \
        == [(1, "ee", "patlee"), (1, "ee", "plee2"), (1, "lee", "patlee"), (1, "lee", "plee2")]
    got = {r.name_key: r.email_match for r in people.with_address_match(named.drop("last_name"), mails, ["business_id", "name_key"]).collect()}
    assert got == {"pat lee": True, "ann ee": False, "jo kline": False}
