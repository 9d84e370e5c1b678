"""Articles and events by product: what counts where, with brute force over made texts."""

import datetime
import random

from tidemark.operators import textevents as T

DAY = datetime.date(2024, 1, 1)
RULES = [
    T.Rule("ban", (("export",), ("ban", "halt")), negative=("lifted",), direction="bullish"),
    T.Rule("harvest", (("crop", "harvest"),), direction="bearish"),
    T.Rule("other", (("strike",),)),
]
WORDS = {"oil": ("rapeseed", "palm"), "grain": ("wheat",), "unused": ("zinc",)}
BRIDGE = {"oil": ("A", "B"), "grain": ("B", "C")}


def test_news_counts_equal_brute_force(spark):
    rng = random.Random(3)
    pool = "export ban halt lifted crop harvest strike rapeseed palm wheat zinc and then".split()
    texts = [None, "", "wheat", *(" ".join(rng.sample(pool, rng.randint(1, 6))) for _ in range(200))]
    want = {}
    for i, text in enumerate(texts):
        held = set((text or "").split())
        rules = [r for r in RULES if all(held & set(g) for g in r.groups) and not held & set(r.negative)]
        for product in {p for f, ps in BRIDGE.items() if held & set(WORDS[f]) for p in ps}:
            row = want.setdefault((DAY + datetime.timedelta(i % 3), product), [0] * 8)
            row[0] += 1
            row[1] += len(rules)
            for k, d in enumerate(("bullish", "bearish", "mixed")):
                row[2 + k] += sum(r.direction == d for r in rules)
            for k, r in enumerate(RULES):
                row[5 + k] += r in rules
    rows = spark.createDataFrame([(DAY + datetime.timedelta(i % 3), t, 1) for i, t in enumerate(texts)], "day date, t string, other int")
    found = T.product_articles(rows, "t", RULES, WORDS, BRIDGE)
    got = {(r.day, r.product): list(r[2:]) for r in T.news_counts(found, ["day", "product"], RULES).collect()}
    assert got == want
    assert T.news_counts(T.product_articles(rows.limit(0), "t", RULES, WORDS, BRIDGE), ["day", "product"], RULES).count() == 0
