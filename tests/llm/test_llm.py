"""The corpus operators against brute force, libraries and planted cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import language_id, licenses, mixing, ngram_join, packing, pii, prefix_tokens, quality_rules, secret_scan, shingles, topk, wordbpe
from tidemark.llm.ngram_join import near_copies, near_links

DATA = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
EDGE = [None, "", " \n", "a", "A b c d", "x " * 3000, "é" * 3000, "1" * 5000, "<|endoftext|> hi", "日本語 text", "  "]


def frame(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns whose names an operator uses itself
        for name in ("rec", "n", "spans", "rank", "length", "chunk", "unit", "size", "kind", "comp"):
            df = df.withColumn(name, F.lit(1))
    return df.withColumn("lang", F.lit("en")).withColumn("source", F.lit("src1"))


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def test_word_bpe_equals_the_library(texts):
    library, fast, rng = Tokenizer.from_file(WORD), wordbpe.WordBpe(WORD), random.Random(1)
    made = ["".join(rng.choice("aé'sSt1 2!?\n ß½İΣ") for _ in range(rng.randint(0, 20))) for _ in range(500)]
    for t in [*texts[:80], *made, *(e or "" for e in EDGE)]:
        assert np.frombuffer(fast.pack(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_prefix_counts_equal_encoding_every_prefix():
    library, counter, rng = Tokenizer.from_file(BYTE), prefix_tokens.PrefixCounter(BYTE), random.Random(2)
    parts = ["a", "the", "'re", "'ve", "ll", " ", "  ", "\n", "é", "日", "😀", "12", "!", "<|endoftext|>", "<|", " ing"]
    for _ in range(400):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))
        want = [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)]
        stored = prefix_tokens.narrow(counter.steps(t))
        assert prefix_tokens.prefix_counts(stored).tolist() == want


def test_count_tokens(spark, texts):
    library = Tokenizer.from_file(BYTE)
    every = [*texts[:60], *EDGE]
    got = {r.doc_id: r for r in prefix_tokens.count_tokens(frame(spark, every, True), BYTE).collect()}
    for i, t in enumerate(every):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512)
    assert prefix_tokens.count_tokens(frame(spark, ["x"]).limit(0), BYTE).count() == 0


def test_packing_plan_is_close_to_optimal():
    rng = np.random.default_rng(0)

    def optimum(items, cap):
        best = len(items)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] >= items[i]:
                    bins[k] -= items[i]
                    go(i + 1, bins)
                    bins[k] += items[i]
            go(i + 1, [*bins, cap - items[i]])

        go(0, [])
        return best

    for _ in range(200):
        cap = int(rng.integers(5, 25))
        items = sorted(rng.integers(1, cap + 1, size=int(rng.integers(1, 8))).tolist(), reverse=True)
        assert packing.plan(np.bincount(items, minlength=cap + 1).astype(np.int64), cap)[1] <= optimum(items, cap) + 1


def test_no_sequence_is_opened_while_a_piece_fits():
    # 13 sequences of two 6s keep a room of 1 each, as many as are filled at once.
    cap, counts = 13, {1: 84, 6: 26}
    runs, n = packing.plan(np.bincount(list(counts), list(counts.values()), minlength=cap + 1).astype(np.int64), cap)
    assert n == 19
    fill = collections.Counter()
    for length in counts:
        own = sorted(r.tolist() for r in runs if r[0] == length)
        for (_, first, sequence, _, per), end in zip(own, [*(r[1] for r in own[1:]), counts[length]], strict=True):
            for place in range(end - first):
                fill[sequence + place // per] += length
    assert sorted(fill.values())[1:] == [cap] * 18


def test_packed_pieces_round_trip(spark, texts):
    library = Tokenizer.from_file(WORD)
    every = [*texts, *EDGE]
    rows = packing.pack_documents(frame(spark, every, True), WORD, 2048).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in enumerate(every):
        ids, at = [*library.encode(t or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(by_doc[i], key=lambda r: r.piece):
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_seq) <= 1.05 * sum(r.length for r in rows) / 2048 + 1


def shingle_strings(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows):
    sets, root = [(d, shingle_strings(t)) for d, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def test_near_copies_equal_brute_force(spark):
    rng, rows = random.Random(4), []
    vocab = [f"w{i}" for i in range(200)]
    passage = [rng.choice(vocab) for _ in range(50)]
    for _ in range(25):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 4, 6, 9, 12, 20, 40, 80, 150]))]
        words = words + passage if rng.random() < 0.4 else words
        for c in range(rng.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(c and rng.randint(0, max(1, len(words) // 20))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy).upper() if c == 1 else " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate(EDGE)]
    got = near_copies(frame(spark, [t for _, t in rows], True)).collect()
    assert sorted(map(tuple, got)) == components(rows)


def test_near_copies_with_frequent_keys_dealt(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_PART", 1.0)
    monkeypatch.setattr(ngram_join, "HOT_HITS", 3)
    rng, rows = random.Random(8), []
    vocab = [f"w{i}" for i in range(300)]
    for size in (4, 30, 90, 250):
        words = [rng.choice(vocab) for _ in range(size)]
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(size)] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", *[rows[20][1]] * 5])]
    docs = frame(spark, [t for _, t in rows], True).repartition(3)
    hot = ngram_join._hot_keys(docs)
    assert hot is not None and ngram_join._dealt(ngram_join._index_rows(docs), hot).filter("salt > 0").count() > hot.count()
    assert sorted(map(tuple, near_copies(docs).collect())) == components(rows)


def _copies(rng, n):
    vocab, rows = [f"w{i}" for i in range(400)], []
    for size in (30, 90, 250):
        words = [rng.choice(vocab) for _ in range(size)]
        for _ in range(n):
            copy = list(words)
            copy[rng.randrange(size)] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_near_copies_in_small_groups_are_listed_without_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_star_pairs", lambda *_: pytest.fail("a round of stars"))
    rows = _copies(random.Random(9), 4)
    assert sorted(map(tuple, near_copies(frame(spark, [t for _, t in rows], True)).collect())) == components(rows)


def test_near_copies_in_large_groups_take_rounds(spark, monkeypatch):
    turns, star = [], ngram_join._star_pairs
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 2)
    monkeypatch.setattr(ngram_join, "_star_pairs", lambda rows, turn: turns.append(turn) or star(rows, turn))
    rows = _copies(random.Random(10), 8)
    assert sorted(map(tuple, near_copies(frame(spark, [t for _, t in rows], True)).collect())) == components(rows)
    assert turns


def test_near_copies_list_no_pairs_within_large_groups(spark, monkeypatch):
    listed, rest = [], ngram_join._rest_pairs
    monkeypatch.setattr(ngram_join, "KEY_ROWS", 50)
    monkeypatch.setattr(ngram_join, "_rest_pairs", lambda rows, sets: listed.append(rest(rows, sets).count()) or rest(rows, sets))
    rows = _copies(random.Random(11), 14)
    assert sorted(map(tuple, near_copies(frame(spark, [t for _, t in rows], True)).collect())) == components(rows)
    assert sum(listed) < 3 * 14  # 273 pairs of copies


def test_near_copies_of_nothing(spark):
    assert near_copies(frame(spark, ["x"]).limit(0)).count() == 0


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
        b = np.unique(np.r_[a[20:], rng.integers(0, 2**63, 15).astype(np.uint64)])
        bits = int(np.bitwise_count((shingles.parity(a) ^ shingles.parity(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))


BASE9 = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_pii_equals_brute_force(spark, texts):
    rng = random.Random(5)
    parts = ["a", "b@c.d", "@", ".", "1", "23", "192.168.0.1", "256.1.1.1", "4111 1111 1111 1111", "-", " ", "+1 (555) 123-4567", "é", "\n", "001", "GB82 WEST 1234 5698 7654 32"]
    every = [*texts, *EDGE, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300))]
    got = {r.doc_id: r for r in pii.summarize(frame(spark, every, True)).collect()}
    for i, t in enumerate(every):
        spans = [(k, *m.span()) for k, p in BASE9.items() for m in re.finditer(p, t or "") if holds(k, m[0])]
        assert [got[i][f"n_{k}"] for k in BASE9] == [sum(s[0] == k for s in spans) for k in BASE9]
        assert got[i].base_sha256 == digest(spans)
    assert any("iban" in r.spans for r in got.values())


def test_secrets_equal_brute_force_and_the_ledger_is_incremental(spark, texts):
    rng = random.Random(6)
    parts = ["password", "=", ":", " ", "'", "SECRET", "toKen", "api_key", "AKIA", "ABCDEFGH12345678", "deadbeef01234567", "abcdef", "é", "K", "ſ", "0"]
    every = [*texts, *EDGE, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300))]
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    base = {"assign": rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    fits = {"assign": lambda m: len(m[2]) >= 12, "access": lambda m: len(m[0]) >= 18, "hex": lambda m: len(m[0]) >= 16}
    df = frame(spark, every, True)
    got = {r.doc_id: r for r in secret_scan.scan_documents(df).collect()}
    for i, t in enumerate(every):
        spans = [(k, *m.span()) for k, p in base.items() for m in re.finditer(p, t or "") if fits[k](m)]
        spans.sort(key=lambda s: (s[1], list(base).index(s[0])))
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[0] == k for s in spans) for k in base)
        assert got[i].base_sha256 == digest(spans)
    _, ledger = secret_scan.scan_versions(df)
    again, new = secret_scan.scan_versions(df.union(df.limit(1).withColumn("text", F.lit("token = abcdefghijkl99"))), ledger)
    assert new.count() == 1 and again.count() == len(every) + 1
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(secret_scan.scan_in_two(df)) == rows(secret_scan.scan_documents(df))
    unnamed = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert rows(secret_scan.scan_in_two(unnamed)) == rows(secret_scan.scan_documents(unnamed))
    assert secret_scan.scan_in_two(df.limit(0)).count() == 0
    half = df.filter("doc_id < 150")
    kept = secret_scan.scan_deliveries([half, df, df])
    assert kept.count() == kept.select("blob").distinct().count() == len({t or "" for t in every})
    clean = secret_scan.redact(df)
    assert clean.columns == df.columns and clean.count() == len(every)
    assert secret_scan.scan_documents(clean).filter("n_assign + n_access + n_hex > 0").count() == 0


def test_mixing_stays_within_a_block(spark):
    units = {"a": 50, "b": 30, "other": 20}
    slots = mixing.period(spark, units).orderBy("at").collect()
    done = collections.Counter()
    for n, r in enumerate(slots, 1):
        done[r.mix_source] += 1
        assert all(abs(done[s] - n * u / 100) < 1 for s, u in units.items())
    docs = spark.createDataFrame([(i, "x" * 10, "a" if i % 2 else None) for i in range(500)] + [(9999, None, "b")], "doc_id long, text string, source string")
    out = mixing.mix(docs, units, 50).collect()
    assert len(out) == 501 and {r.mix_source for r in out} == {"a", "b", "other"}
    assert mixing.mixed_documents(docs, units, 50).count() == 501
    assert mixing.mix(docs.limit(0), units).count() == 0


def test_license_lines(spark):
    lines = ["Released under the MIT license", "released UNDER the mit License.\nfoo", "Released under the MIT", "nothing here", None, "", "MIT"]
    found = {(r.doc_id, r.line, r.license) for r in licenses.scan_licenses(frame(spark, lines, True)).collect()}
    assert found == {(0, 0, "MIT"), (1, 0, "MIT"), (2, 0, "MIT")}


def test_quality_statistics_equal_brute_force(spark, texts):
    every = [*texts[:100], *EDGE, "a b c a b c", "x x x x", "a\n\na\n a\n"]
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, every, True), spark.createDataFrame([], "doc_id long, quality int")).collect()}
    for i, t in enumerate(every):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        count = collections.Counter(windows)
        marked = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(marked))
        assert tuple(got[i][1:6]) == want
        assert got[i].base_failed == (len(words) < 50 or 100 * len(marked) > 50 * len(words))


def test_rules_are_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality_rules.judge(docs, labels).join(labels, "doc_id").filter("not base_failed")
    right = out.filter("kept = (quality = 1)").count() / out.count()
    assert right > 0.9


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    want = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        p = np.exp(moves[:, path[0]]).sum() * np.exp(sum(scores[t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        for t, s in enumerate(path):
            want[t, s] += p
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(language_id.marginals(scores, np.array([5]), moves), want)


def test_every_letter_run_and_n_gram_is_read():
    grams = lambda w: [zlib.crc32(b[i : i + 3]) % language_id.BUCKETS for b in [f"<{w}>".encode()] for i in range(len(b) - 2)]
    for word in ("a", "x" * 39, "xy" * 20, "abcdefghij" * 30, "日本語の文" * 50):
        pieces, whole = language_id.features(word), grams(word)
        assert [len(p) for p in pieces] == [min(40, len(whole) - i) + 4 * (i == 0) + 3 * (i + 40 >= len(whole)) for i in range(0, len(whole), 40)]
        assert collections.Counter(whole) <= collections.Counter(itertools.chain.from_iterable(pieces))
    rng = random.Random(8)
    vocab = {"aa": [f"kre{c}{d}um" for c in "abcdef" for d in "xyzw"], "bb": [f"ost{c}{d}lig" for c in "abcdef" for d in "xyzw"]}
    made = [(lang, [rng.choice(v) for _ in range(30)]) for lang, v in vocab.items() for _ in range(100)]
    model = language_id.fit([*made, ("cc", ["日本語" * 20, "漢字" * 30] * 5)] + [("dd", ["한국어" * 20] * 5)])
    labeller = language_id.Labeller(model)
    for sep in (",", "/", "-", "_", "4"):
        text = sep.join(["kreaxumkreaxumx", *(rng.choice(vocab["bb"]) for _ in range(9))])
        apart = re.sub("[,/_4-]", " ", text)
        assert labeller.predict([text, "1 ;", apart])[0] == ["bb", "und", "bb"]
        (_, _, _), (s, _, t) = labeller.predict([text, "1 ;", apart])
        assert s == t
    assert len(labeller._rows("kreaxum,ostbxlig  7 ostbxlig/" + "x" * 200)) == 3 + 5


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.95
    edge = {r.doc_id: r.lang_pred for r in language_id.identify(frame(spark, EDGE, True)).collect()}
    assert [edge[i] for i in (0, 1, 2, 7)] == ["und"] * 4


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(300, None), (350, [1.0, None] + [0.0] * 6), (400, [float("nan")] * 8), (450, [float("inf")] + [0.0] * 7), (500, rows[3][1]), (501, rows[3][1]), (501, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(0))
    got = collections.defaultdict(list)
    for r in topk.top_k(df, 50, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    # As the contract and the query's SQL say, every row is a candidate, repeated ones too.
    whole = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    want = {q: sorted(((x, int(a @ b)) for x, b in whole if x != q), key=lambda p: (-p[1], p[0]))[:5] for q, a in whole if q % 50 == 0}
    assert dict(got) == want
    assert topk.top_k(df.limit(0)).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = docs
    for _, stage in c.STAGES[:-1]:
        kept = stage(spark, kept, DATA)
        assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = sorted({r[2] for r in components([(r.doc_id, r.text) for r in docs.collect()])})
    assert sorted(ids) == want
    assert c.run(spark, DATA).select("doc_id").distinct().count() == len(want)


def test_pipeline_follows_the_target_weights(spark, monkeypatch):
    import corpus_pipeline as c

    key = lambda: sorted(tuple(r) for r in c.run(spark, DATA).collect())
    rows = key()
    assert rows == key()
    last = max(r[5] for r in rows)
    monkeypatch.setattr(c, "MIX_UNITS", {"src0": 1, "src1": 90, "other": 9})
    other = key()
    assert [r[:5] for r in other] == [r[:5] for r in rows] and other != rows
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    share = lambda out: sum(r[3] for r in out if source[r[0]] == "src1" and r[5] < last / 4)
    assert share(other) >= share(rows)


def test_pipeline_stages_decide_by_row(spark):
    import corpus_pipeline as c

    one, two = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(None, one), (None, one), (None, two), (5, two), (5, two), (3, two), (7, "a b c d e f g h"), (7, "k l m n o p q r"), (8, None), (8, None), (None, "")]
    docs = spark.createDataFrame([(d, t, "en", "src1", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    see = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    assert see(c.language_id(spark, docs, DATA)) == sorted((r for r in rows if r[1]), key=repr)
    kept = [(None, one), (3, two), (7, "a b c d e f g h"), (7, "k l m n o p q r"), (8, None), (8, None), (None, "")]
    assert see(c.ngram_jaccard_join(spark, docs, DATA)) == sorted(kept, key=repr)
    for stage in (c.secret_scan, c.pfair_mixing):
        assert see(stage(spark, docs, DATA)) == sorted(rows, key=repr)
    assert len(c.best_fit_packing(spark, docs, DATA).collect()) == len(rows)


def elapsed(f):
    begin = time.time()
    f()
    return time.time() - begin


def test_pii_grows_with_matches_also_under_a_filter(spark):
    made = lambda n: frame(spark, [" ".join(f"{i:05d}" for i in range(n)), " ".join(f"a{i}@b.cd" for i in range(n))]).repartition(1)
    see = lambda n: pii.summarize(made(n)).filter("n_email > 0").collect()
    see(100)
    short, long = elapsed(lambda: see(8_000)), elapsed(lambda: see(16_000))
    assert long < 2.5 * short + 2
    row = see(1_000)[0]
    at, spans = 0, []
    for i in range(1_000):
        spans.append(("email", at, at + len(f"a{i}@b.cd")))
        at = spans[-1][2] + 1
    assert (row.n_email, row.base_sha256) == (1_000, digest(spans))


def test_quality_of_a_long_text_under_filters(spark):
    rng = random.Random(9)
    text = " ".join(rng.choice(["a", "b", "the", f"w{rng.randint(0, 5000)}"]) for _ in range(20_000))
    out = quality_rules.judge(frame(spark, [text, None, "a b"]).repartition(1), spark.createDataFrame([], "doc_id long, quality int"))
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].n_words == 20_000 and rows[0].n_repeat_words > 5
    begin = time.time()
    for keep, condition in ((lambda r: r.kept, "kept"), (lambda r: r.n_repeat_words > 5, "n_repeat_words > 5"), (lambda r: not r.base_failed, "not base_failed")):
        assert sorted(r.doc_id for r in out.filter(condition).collect()) == [i for i, r in sorted(rows.items()) if keep(r)]
    assert time.time() - begin < 60


def test_rules_equal_a_plain_sequential_covering(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.learn(docs, labels)
    stats = quality_rules.statistics(docs).join(labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q1")).filter("q = q1"), "doc_id")
    rows = stats.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))).toPandas()
    rows["bad"] = rows.q == 0
    grow, prune = rows[rows.part < 2], rows[rows.part == 2]
    n = quality_rules.CUTS + 1
    # The least value that at least the k-th part of the rows doesn't exceed.
    cuts = {f: sorted({sorted(grow[f])[max(0, -(-k * len(grow) // n) - 1)] for k in range(1, n)}) for f in quality_rules.FEATURES}

    def covered(part, rule):
        inside = np.ones(len(part), dtype=bool)
        for f, above, cut in rule:
            inside &= (part[f] > cut if above else part[f] <= cut).to_numpy()
        return inside

    want = []
    while len(want) < quality_rules.MAX_RULES:
        rule = []
        while len(rule) < quality_rules.MAX_CONDITIONS:
            inside = grow[covered(grow, rule)]
            bad = inside.bad.mean() if len(inside) else 0
            if not 0 < bad < 1:
                break
            best = None
            for f, some in cuts.items():
                for cut in some:
                    for above in (False, True):
                        left = inside[covered(inside, [(f, above, cut)])]
                        if len(left) >= quality_rules.LEAST_ROWS:
                            gain = left.bad.sum() * (np.log2(left.bad.mean()) - np.log2(bad)) if left.bad.any() else 0.0
                            best = max(best or (0.0, ""), (gain, str(quality_rules.Condition(f, above, cut)), (f, above, cut)), key=lambda b: b[:2])
            if best is None or best[0] <= 0:
                break
            rule.append(best[2])
        if not rule:
            break
        worth = [(lambda p: (p.bad.sum() - (~p.bad).sum()) / max(1, len(p)))(prune[covered(prune, rule[:k])]) for k in range(1, len(rule) + 1)]
        rule = rule[: int(np.argmax(worth)) + 1]
        inside = prune[covered(prune, rule)]
        if not len(inside) or inside.bad.sum() < quality_rules.LEAST_PURITY * len(inside):
            break
        want.append(rule)
        grow, prune = grow[~covered(grow, rule)], prune[~covered(prune, rule)]
    assert [[(c.feature, c.above, c.cut) for c in rule] for rule in rules] == want and want


def test_near_links_are_all_links(spark):
    rng = random.Random(11)
    vocab, rows = [f"w{i}" for i in range(300)], []
    for size in (3, 8, 15, 30, 60, 100, 200):
        words = [rng.choice(vocab) for _ in range(size)]
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, size // 40))):
                copy[rng.randrange(size)] = rng.choice(vocab)
            rows += [" ".join(copy)] * rng.choice([1, 1, 2])
    rows += ["", None]
    links, members = near_links(frame(spark, rows, True))
    first, want = {}, set()
    sets = [shingle_strings(t) for t in rows]
    for i, s in enumerate(sets):
        first.setdefault(s or i, i)
    for (x, i), (y, j) in itertools.combinations([(s, i) for s, i in first.items() if not isinstance(s, int)], 2):
        if 100 * len(x & y) >= 80 * len(x | y):
            want.add((i, j, len(x & y), len(x), len(y)))
    assert sorted(map(tuple, links.collect())) == sorted(want) and want
    assert sorted(map(tuple, members.collect())) == [(i, first[s or i]) for i, s in enumerate(sets)]


def test_top_k_of_many_rows_with_a_frequent_vector(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 256)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8))
    vectors = np.concatenate([centres[rng.integers(0, 20, 4000)] + rng.normal(scale=0.1, size=(4000, 8)), np.tile(centres[0], (2000, 1))]).round(3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())] + [(9_999, [])], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, 50, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = np.vstack([np.floor(256 * vectors), np.zeros(8)]).astype(np.int64)
    ids = np.array([*range(len(vectors)), 9_999])
    for q in range(0, len(vectors), 50):
        scores = whole @ whole[q]
        order = np.lexsort((ids, -scores))
        assert got[q] == [(int(ids[i]), int(scores[i])) for i in order if ids[i] != q][:5]
    assert len(got) == len(range(0, len(vectors), 50))


def test_a_source_without_rows_ends_the_mix(spark):
    units = {"a": 50, "b": 30, "other": 20}
    docs = spark.createDataFrame([(i, "x" * 10, "a" if i % 2 else "b") for i in range(200)] + [(None, "x" * i, None) for i in range(9)], "doc_id long, text string, source string")
    out = mixing.mix(docs.filter("source is not null"), units, 50)
    first = min(r.at for r in mixing.period(spark, units).collect() if r.mix_source == "other")
    assert {(r.slot < first) == r.in_mix for r in out.collect()} == {True}
    assert mixing.mix(docs, units, 50).count() == 209


def test_language_of_numbers_and_without_labels(spark):
    import corpus_pipeline as c

    docs = frame(spark, ["the cat and the dog", "le chat et le chien", "½ ²", "Ⅷ ①", "1 2", None, "the end"]).withColumn("lang", F.expr("if(text like 'le %', 'fr', 'en')"))
    labels = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert [labels[i] for i in (2, 3, 4, 5)] == [("und", 0.0)] * 4
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in c.language_id(spark, bare, DATA).collect()) == [0, 1, 6]
    model = language_id.fit([("en", "the cat and the dog".split()), ("fr", "le chat et le chien".split())] * 40)
    assert sorted(r.doc_id for r in language_id.recognized(frame(spark, ["the dog and", "漢字", "!"]), model).collect()) == [0]


def test_pipeline_of_nothing_and_of_more_columns(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for given in (docs.limit(0), docs.limit(20).withColumn("chunk", F.lit(1)).withColumn("rec", F.lit("x")).withColumn("slot", F.lit(2.5))):
        kept = given
        for _, stage in c.STAGES[:-1]:
            kept = stage(spark, kept, DATA)
            assert kept.columns == given.columns
        assert c.best_fit_packing(spark, kept, DATA).count() == 0 or given.count()


def test_operators_of_nothing_and_of_repeated_rows(spark):
    none, labels = frame(spark, ["x"]).limit(0), spark.createDataFrame([], "doc_id long, quality int")
    runs = {
        "op1": lambda d: prefix_tokens.count_tokens(d, BYTE), "op2": lambda d: mixing.mix(d, {"src1": 1, "other": 1}), "op3": secret_scan.scan_in_two,
        "op5": licenses.scan_licenses, "op6": lambda d: packing.pack_documents(d, WORD), "op7": near_copies, "op8": language_id.identify,
        "op9": pii.summarize, "op10": lambda d: quality_rules.judge(d, labels),
    }
    twice = frame(spark, ["Released under the MIT license."])
    twice = twice.union(twice)
    for name, run in runs.items():
        assert run(none).count() == 0, name
        assert run(twice).count() == 2, name


def test_license_over_lines_and_in_longer_lines(spark):
    grant = licenses.TEMPLATES["MIT-grant"].split()
    wrapped = "/*\n * " + "\n * ".join(" ".join(grant[i : i + 7]) for i in range(0, len(grant), 7)) + "\n */"
    texts = [wrapped, "Copyright by them.\nReleased under the MIT License. See the file for details and more.", wrapped.replace("charge", "cost"), "permission is granted to any person", None, "x\n" + licenses.TEMPLATES["MIT"]]
    found = {(r.doc_id, r.line, r.license): r.dice for r in licenses.scan_licenses(frame(spark, texts, True)).collect()}
    assert set(found) == {(0, 1, "MIT-grant"), (1, 1, "MIT"), (2, 1, "MIT-grant"), (5, 1, "MIT")}
    assert found[0, 1, "MIT-grant"] == found[1, 1, "MIT"] == 1.0 > found[2, 1, "MIT-grant"]


def test_every_line_like_a_notice_holds_a_sign():
    rng = random.Random(5)
    grams = lambda w: {*zip(w, w[1:])} if len(w) > 1 else {(x,) for x in w}
    notices = {**licenses.TEMPLATES, "one": "Proprietary", "same": "free free free free"}
    held, signs = 0, {least: set(licenses.signs(notices, least)) for least in (0.5, 0.8, 1.0)}
    known = [re.findall("[a-z0-9]+", n.lower()) for n in notices.values()]
    for _ in range(4000):
        line = [w for w in rng.choice(known) if rng.random() > rng.choice((0.02, 0.1, 0.3))]
        for _ in range(rng.randrange(4)):
            line.insert(rng.randrange(len(line) + 1), rng.choice(("the", "x")))
        for least, some in signs.items():
            best = max((2 * len(grams(line) & grams(k)) / (len(grams(line)) + len(grams(k))) for k in known), default=0) if line else 0
            if best >= least:
                held += 1
                assert some & set(line), (least, line)
    assert held > 1000


def test_license_windows_with_their_longest_pairs_changed(spark):
    words = licenses.TEMPLATES["GPL-grant"].split()
    longest = sorted(range(len(words)), key=lambda k: -len(words[k]))[:2]
    changed = " ".join("x" if k in longest else w for k, w in enumerate(words))
    found = licenses.scan_licenses(frame(spark, [f"some words before it\n{changed} and some more after it", changed])).collect()
    assert {(r.doc_id, r.license) for r in found} == {(0, "GPL-grant"), (1, "GPL-grant")}


def every_window(text, notices, least=0.8):
    """By trying all windows: what ``scan_licenses`` tells of them, and all that match, by notice as (start, end)."""
    split = lambda x: re.findall("[a-z0-9]+", x.lower())
    grams = lambda w: {*itertools.pairwise(w)}
    dice = lambda g, h: 2 * len(g & h) / (len(g) + len(h))
    lines = [split(x) for x in text.split("\n")]
    words, line_of = [w for x in lines for w in x], [i for i, x in enumerate(lines) for _ in x]
    told, matches = {}, {}
    for name, notice in notices.items():
        g = grams(split(notice))
        need, most = math.ceil(len(g) * least / (2 - least) - 1e-9), int(len(g) * (2 - least) / least + 1e-9)
        best = {}
        for a in range(len(words) - 1):
            for n in range(1, min(most, len(words) - a - 1) + 1):
                d = dice(g, grams(words[a : a + n + 1]))
                if d >= least:
                    matches.setdefault(name, []).append((a, a + n))
                    if (words[a], words[a + 1]) in g:
                        best[a] = min(best.get(a, (0, 0, 0)), (-d, a, n))
        at = sorted(best)
        while at:
            d, a, n = min(best[x] for x in at if x < at[0] + need)
            told.setdefault(name, []).append((line_of[a], -d, a, a + n, dice(g, grams(lines[line_of[a]])) >= least))
            at = [x for x in at if x >= a + n]
    return told, matches


def test_license_windows_equal_trying_all(spark):
    rng = random.Random(11)
    notices = {k: licenses.TEMPLATES[k] for k in ("MIT", "all-rights", "GPL-3.0", "BSD-grant", "MIT-grant")} | {"twice": "to be or not to be or to be"}
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            w = re.findall("[A-Za-z0-9]+", notices[rng.choice(list(notices))])
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(w))
                w[k : k + rng.randint(0, 1)] = rng.choice(([], ["x"], [w[k]], ["the"], [w[k], "license"]))
                w = w or ["x"]
            parts += [*w, *(rng.choice("the license of x to be".split()) for _ in range(rng.choice((0, 0, 3, 12))))]
        texts.append("".join(w + rng.choice(("  ", " ", " ", ", ", "\n")) for w in parts))
    got = collections.Counter((r.doc_id, r.line, r.license, r.dice) for r in licenses.scan_licenses(frame(spark, texts), notices).collect())
    want, seen = collections.Counter(), 0
    for i, text in enumerate(texts):
        told, matches = every_window(text, notices)
        for name, found in told.items():
            want.update((i, line, name, round(d, 6)) for line, d, _, _, own in found if not own)
        for name, found in matches.items():
            seen += len(found)
            assert all(any(a < end and start < b for _, _, start, end, _ in told[name]) for a, b in found), (i, name)
        for line, part in enumerate(text.split("\n")):
            w = re.findall("[a-z0-9]+", part.lower())
            h = {*itertools.pairwise(w)} or {*w}
            for name, notice in notices.items():
                g = {*itertools.pairwise(re.findall("[a-z0-9]+", notice.lower()))}
                if w and 2 * len(g & h) / (len(g) + len(h)) >= 0.8:
                    want[i, line, name, round(2 * len(g & h) / (len(g) + len(h)), 6)] += 1
    assert got == want
    assert seen > 1000


def test_license_texts_whole_and_many_in_one_text(spark):
    wrapped = "\n".join(" * " + x for x in re.findall(r"(?:\S+\s+){1,9}", licenses.TEMPLATES["ISC-text"] + " "))
    changed = re.sub("(?i)the author", "THE COPYRIGHT HOLDER", wrapped)
    many = "Released under the MIT License. foo bar baz\n" * 3000
    copies = "\n".join(re.findall(r"(?:\S+\s+){1,9}", (licenses.TEMPLATES["Zlib-text"].replace("\n", " ") + " ") * 40))
    found = licenses.scan_licenses(frame(spark, [wrapped, changed, many, copies])).groupBy("doc_id", "license").agg(F.count("*").alias("n"), F.max("dice").alias("dice"))
    found = {(r.doc_id, r.license): (r.n, r.dice) for r in found.collect()}
    assert found[0, "ISC-text"] == (1, 1.0) and found[1, "ISC-text"][0] == 1 and 0.8 < found[1, "ISC-text"][1] < 1
    assert found[2, "MIT"] == (3000, 1.0) and found[3, "Zlib-text"] == (40, 1.0)
