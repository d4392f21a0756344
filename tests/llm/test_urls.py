"""URL verdicts against plain versions of every step."""

import itertools
import math
import random
import re
from collections import Counter

import pytest

from clinicweave.llm import urls

RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")
PAGES = [
    (1, "http://Blog.Example.NET/en/1?x=/a#b", "<p>cheap news online</p>"),
    (2, "https://www.cheap-pills.example.com/en/2", "<b>the cheap</b> pills the"),
    (3, "https://cheapcasino.example.com", "news the the online cheap"),
    (4, "https://example.com/de/x", None),
    (5, "https://notexample.com/de/x", ""),
    (6, "ftp://a.org/fr/://x.net/", "news"),
    (7, "no scheme", "news"),
    (8, None, "online online online"),
    (9, "://", ""),
    (10, "x://net", "x"),
    (11, "x://net/", "x"),
    (12, "x://NET?/", "x"),
    (13, "http://ÄÖ.net#/en/", "x"),
    (14, "http://a.b\n.net/x\ny?z", "<a\nhref>news</a>"),
    (15, "http://cheapcasino.example.com/en/", "x"),
    (15, "http://cheapcasino.example.com/en/", "x"),
    (None, "http://news-online.example.com/casino/", "x"),
    (16, "http://" + "newsonline" * 20_000 + ".com/" + "cheap/" * 20_000, "x"),
]


def plain_place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, lines):
    best = None
    for line in lines:
        verdict, text = line.split()
        h, p = text[: text.index("/")], text[text.index("/") :]
        if host and (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def table(spark, pages):
    return spark.createDataFrame([(i, u, h, "x", 1.0) for i, u, h in pages], "page_id long, url string, html string, host string, score double")


def plain_cost(words, name):
    """The least cost of any way to cut a name, by trying all of them."""
    best = math.inf
    for cuts in itertools.product((False, True), repeat=max(len(name) - 1, 0)):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(name)]
        pieces = [name[a:b] for a, b in itertools.pairwise(at)]
        for kinds in itertools.product((False, True), repeat=len(pieces)):
            if any(a and b for a, b in itertools.pairwise(kinds)) or any(not k and p not in words.costs for k, p in zip(kinds, pieces, strict=True)):
                continue
            best = min(best, sum(words.per_word + words.per_character * len(p) if k else words.costs[p] for k, p in zip(kinds, pieces, strict=True)))
    return best


def cost_of(words, pieces):
    return sum(words.costs[p] if p in words.costs else words.per_word + words.per_character * len(p) for p in pieces)


def test_split_is_the_cheapest_of_all():
    rng = random.Random(2)
    for n in range(60):
        words = urls.Words({"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(1, 500) for _ in range(8)})
        name = "".join(rng.choices("abcz", k=rng.randint(0, 8)))
        pieces = words.split(name)
        assert "".join(pieces) == name
        if name:
            assert cost_of(words, pieces) == pytest.approx(plain_cost(words, name))
    words = urls.Words({"the": 500, "road": 50, "roads": 30, "cheap": 40, "free": 40, "on": 300, "line": 40, "online": 30})
    assert words.split("freecasinoonline") == ["free", "casino", "online"]
    assert words.split("theroads") == ["the", "roads"] and words.split("zzqx") == ["zzqx"] and words.split("") == []
    assert words.tokens("www.cheappills-24.example/ROADS") == ["?", "cheap", "pills", "#", "?", "roads"]


def test_rules_against_a_scan():
    lines = [*RULES, "block a.b.org/x", "allow b.org/x/y", "block co.uk/", "allow x.co.uk/"]
    rules = urls.Rules(urls.parse_rules(lines))
    rng = random.Random(3)
    for _ in range(4000):
        host = ".".join(rng.choices(["a", "b", "x", "org", "net", "example", "com", "co", "uk", ""], k=rng.randint(0, 4)))
        path = rng.choice(["", "/", "/x", "/x/y", "/x/yz", "/en/", "/en", "/de/1", "/fr/"])
        found, want = rules.fitting(host, path), plain_rule(host, path, lines)
        assert (found and (found.text, found.verdict)) == want
    with pytest.raises(ValueError):
        urls.parse_rules(["deny net/"])


def test_verdicts_against_plain_counts(spark):
    got = urls.url_verdicts(table(spark, PAGES), urls.parse_rules(RULES)).collect()
    assert len(got) == len(PAGES)
    # Plain counts of words, tokens and classes.
    text = Counter()
    for _, u, h in PAGES:
        for w in re.findall(r"[^\W\d_]+", re.sub("<[^>]*>", " ", h or "").lower() + " " + " ".join(plain_place(u)).lower()):
            text[w] += len(w) <= urls.LONGEST_WORD
    words = urls.Words({w: n for w, n in text.items() if n >= urls.LEAST_COUNT})
    tokens, rows = {}, [0, 0]
    for _, u, _ in PAGES:
        host, path = map(words.tokens, plain_place(u))
        kind = int(not urls.SEEDS.isdisjoint(host))
        rows[kind] += 1
        for t in host + path:
            tokens.setdefault(t, [0, 0])[kind] += 1
    total = [sum(t[k] for t in tokens.values()) + len(tokens) + 1 for k in (0, 1)]
    scores = {}
    for _, u, _ in PAGES:
        host, path = plain_place(u)
        odds = math.log((rows[1] + 1) / (rows[0] + 1)) + sum(math.log((tokens[t][1] + 1) / total[1] / ((tokens[t][0] + 1) / total[0])) for t in words.tokens(host) + words.tokens(path))
        scores[u] = 0.0 if not host and not path else 1 / (1 + math.exp(-max(-700, min(700, odds))))
    by_url = {u: (plain_place(u), plain_rule(*plain_place(u), RULES)) for _, u, _ in PAGES}
    assert sorted((r["page_id"] or -1, r["host"], r["path"]) for r in got) == sorted((i or -1, *plain_place(u)) for i, u, _ in PAGES)
    for r in got:
        u = next(u for i, u, _ in PAGES if i == r["page_id"])
        (host, path), rule = by_url[u]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["score"] == pytest.approx(scores[u])
        assert r["verdict"] == (rule[1] if rule else "block" if scores[u] >= 0.5 else "allow")
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert verdict[2] == verdict[3] == "block" and verdict[8] == verdict[9] == "allow"


def test_words_of_a_bounded_model_are_whole_classes(spark):
    rng = random.Random(4)
    words = [f"w{'abcdefgh'[i % 8]}{'xyz'[i // 8 % 3]}{'klm'[i // 24]}" for i in range(60)]
    texts = [" ".join(rng.choices(words, weights=range(1, 61), k=200)) for _ in range(20)]
    n = Counter(" ".join(texts).split())
    df = spark.createDataFrame([(f"<b {i}>{t.upper()}</b>",) for i, t in enumerate(texts)], "t string")
    for most in (0, 1, 10, 30, 1000):
        got = urls.count_words(df, "t", max_words=most)
        assert len(got) <= most and all(n[w] == c for w, c in got.items())
        left = [c for w, c in n.items() if w not in got and c >= urls.LEAST_COUNT]
        if got and left:
            assert min(got.values()) > max(left)
        assert most < 1000 or len(got) == sum(c >= urls.LEAST_COUNT for c in n.values())


def test_urls_without_texts_and_an_empty_table(spark):
    pages = [(i, f"https://{'cheap-casino' if i % 10 == 0 else 'daily-news'}.example.com/{i}", None) for i in range(200)]
    got = urls.url_verdicts(table(spark, pages), [], text_col=None).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == set(range(0, 200, 10)) and all(r["rule"] is None for r in got)
    assert urls.url_verdicts(table(spark, []), urls.parse_rules(RULES)).count() == 0


def test_words_written_together_are_found_by_what_other_names_teach(spark):
    """Names whose own words are no seeds, but stand beside seeds elsewhere, on a hold-out of names written together."""
    rng = random.Random(5)
    bad, good = ["win", "cheap", "fast", "bonus", "vip"], ["daily", "garden", "school", "river", "music"]
    pages = [(i, f"http://{rng.choice(['casino', 'pills'])}-{rng.choice(bad)}.com/" if i % 4 == 0 else f"http://{rng.choice(good)}-{rng.choice(good)}.com/", None) for i in range(800)]
    pages += [(1000 + k, f"http://{a}{b}.com/", None) for k, (a, b) in enumerate(itertools.permutations(bad, 2))] + [(2000 + k, f"http://{a}{b}.com/", None) for k, (a, b) in enumerate(itertools.permutations(good, 2))]
    got = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(table(spark, pages), []).collect()}
    assert all(v == ("block" if i < 2000 else "allow") for i, v in got.items() if i >= 1000)
