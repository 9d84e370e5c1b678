"""Operators 11 to 13 against brute force, the library and SQL."""

import collections
import functools
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import balanced_packing, centroids, conversations, language_id
from tidemark.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
SPACES = " \t\n\x0b\f\r"


# Operator 11


def cheapest(rows):
    """(cost, audit, repaired rows) of (role, text, fault) rows, by trying every edit at every row."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def go(i, last, inserted):
        """The best of (cost, audit, output) from row i on, the last written row being ``last``."""
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            more = 5 * (fault == "truncated")
            cost, audit, out = go(i + 1, last, 0)
            options.append((cost + 2, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                if role[:1] == following[last] or role[:1] == "s" and last == "":
                    cost, audit, out = go(i + 1, role[0], 0)
                    options.append((cost + more, "K" + audit, ((role, text), *out)))
                for to in "ua":
                    if to == following[last]:
                        cost, audit, out = go(i + 1, to, 0)
                        options.append((cost + 1 + more, "R" + audit, ((names[to], text), *out)))
        if inserted < 3:
            to = following[last]
            cost, audit, out = go(i, to, inserted + 1)
            options.append((cost + 5, "I" + audit, ((names[to], ""), *out)))
        return min(options) if options else (10**9, "", ())

    return go(0, "", 0)


def repaired(rows):
    """What the contract says of one conversation's (conv_id, turn, role, text) rows."""
    after = []
    for conv, turn, role, text in rows:
        key, role, text = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}", " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32]))
    seen, marked = set(), []
    for _, role, text in after:
        end = text.rstrip(SPACES)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = [t for t, *_ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = collections.Counter(f for *_, f in marked)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, out = cheapest(tuple(marked))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def conversation_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_block_tables_equal_trying_all_edits():
    rng, table = random.Random(3), conversations.tables()
    kinds = [("x", None)] + [(i, cut) for i in "suao" for cut in (False, True)]
    for _ in range(1500):
        symbols = [rng.randrange(conversations.SYMBOLS) for _ in range(rng.randint(0, 11))]
        rows = tuple(("user", "", "blank") if kinds[s][0] == "x" else (kinds[s][0], "t", "truncated" if kinds[s][1] else "") for s in symbols)
        assert table.audit(bytes(symbols)) == cheapest(rows)[:2]


def test_conversations_equal_brute_force(spark):
    rng, rows = random.Random(4), []
    texts = ["Yes.", "No", "", " \n", "Why? ", "ok!", "x" * 40 + ".", None, "é.\t", "a.b"]
    for conv in [None, *range(400)]:
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([None, turn, turn, turn, turn + rng.randint(0, 3)])
            rows.append((conv, at, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice(texts)))
    rows += rows[:30]
    # Ids and turns whose rows all go: a conversation of zeros.
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Hi."))
    by_conv = collections.defaultdict(list)
    for row in rows:
        by_conv[row[0]].append(row)
    frame = conversation_frame(spark, rows)
    for name in ("plan", "digest", "fault", "kind", "copy"):
        frame = frame.withColumn(name, F.lit(1))
    got = conversations.repair(frame).collect()
    assert len(got) == len(by_conv) == len({r.conv_id for r in got})
    for r in got:
        assert tuple(r[1:]) == repaired(by_conv[r.conv_id]), by_conv[r.conv_id]
    zero = next(r for r in got if r.conv_id == gone)
    assert tuple(zero[1:]) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_driver_conversations_equal_brute_force(spark):
    by_conv = collections.defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        by_conv[r.conv_id].append((r.conv_id, r.turn, r.role, r.text))
    got = QUERIES["op11_conversation_repair"](spark, DATA).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == {c: repaired(rows) for c, rows in by_conv.items()}


def test_one_conversation_of_many_rows_and_long_texts(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Fine.", "cut off", f"{t} words. " * 20])) for t in range(20_000)]
    rows += [(8, 0, "user", "long. " * 400_000), (8, 1, "assistant", "end.")]
    got = {r.conv_id: r for r in conversations.repair(conversation_frame(spark, rows)).collect()}
    for conv in (7, 8):
        want = repaired_by_tables([r for r in rows if r[0] == conv])
        assert (got[conv].cost, got[conv].repaired_sha256) == want
    assert conversations.repair(conversation_frame(spark, [])).count() == 0


def repaired_by_tables(rows):
    """Cost and digest without recursion: costs from the end, then edits from the start."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    after = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            after += [("user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    seen, marked = set(), []
    for role, text in after:
        end = text.rstrip(SPACES)
        marked.append((role, text, not end or (role, text) in seen, 5 * (bool(end) and end[-1] not in ".!?")))
        seen.add((role, text))
    left = [{"": 0, "s": 10, "u": 5, "a": 0}]
    for role, _, gone, more in reversed(marked):
        nxt = left[-1]
        here = {q: min([2 + nxt[q]] + ([] if gone else [1 + more + nxt[step[q]]] + ([more + nxt[role[0]]] if role[0] == step[q] else []))) for q in step}
        for _ in range(2):
            here = {q: min(here[q], 5 + here[step[q]]) for q in step}
        left.append(here)
    left.reverse()
    state, out = "", []
    names = {"u": "user", "a": "assistant"}
    for i, (role, text, gone, more) in enumerate(marked):
        while True:
            here, nxt = left[i], left[i + 1]
            if 2 + nxt[state] == here[state]:
                break
            if 5 + here[step[state]] == here[state]:
                state = step[state]
                out.append(f"{names[state]}:")
                continue
            state = step[state]
            out.append(f"{names[state]}:{text}")
            break
    while state == "u":
        state = "a"
        out.append("assistant:")
    return left[0][""], hashlib.sha256("\n".join(out).encode()).hexdigest()


# Operator 12


def brute_clusters(vectors, k, rounds):
    """Clusters of (id, integer vector) pairs with Python's integers."""
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in vectors)
    cents = [list(v) for _, v in order[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for r in range(rounds + 1):
        found = [min((dist(v, c), n) for n, c in enumerate(cents)) for _, v in vectors]
        if r < rounds:
            for n in range(len(cents)):
                own = [v for (_, v), (_, c) in zip(vectors, found) if c == n]
                if own:
                    cents[n] = [sum(x) // len(own) for x in zip(*own)]
    return sorted((str(i), c, min(d, 2**63 - 1), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(vectors, found))


def embedding_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("known", F.lit(1)).withColumn("v", F.lit("x")).withColumn("cluster", F.lit(9))


def test_clusters_equal_brute_force(spark):
    rng = random.Random(6)
    made = [(i, [rng.choice([0, 1, 2, 5]) / 256 for _ in range(4)]) for i in range(150)]
    made += made[:20] + [(None, [0.5] * 4)] + [(1000 + i, [0.25] * 4) for i in range(60)]
    left_out = [(1, None), (2, [None] * 4), (3, [float("nan")] * 4), (4, [float("inf"), 0.0, 0.0, 0.0]), (5, [1.0] * 3), (6, []), (7, [1.0] * 5)]
    for k, rounds in ((7, 5), (3, 0), (300, 2)):
        rows = centroids.cluster(embedding_frame(spark, made + left_out), k, rounds, 4).collect()
        want = brute_clusters([(i, [int(x * 256 // 1) for x in v]) for i, v in made], k, rounds)
        assert sorted((str(r.vec_id), r.cluster, r.distance, r.centroid_sha256) for r in rows) == want
        inertia = collections.Counter()
        for r in rows:
            inertia[r.cluster] += r.distance
        assert all((r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values())) for r in rows)
    assert centroids.cluster(embedding_frame(spark, left_out), 3, 2, 4).count() == 0


def test_huge_components_stay_exact(spark):
    rng = random.Random(7)
    made = [(i, [float(rng.choice([-3, 1, 2]) * 2**e) for e in (10, 30, 44, 52)]) for i in range(60)]
    rows = centroids.cluster(embedding_frame(spark, made), 5, 3, 4).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.centroid_sha256) for r in rows) == brute_clusters([(i, [int(x) * 256 for x in v]) for i, v in made], 5, 3)


def test_pivots_leave_centroids_unmeasured():
    rng = np.random.default_rng(8)
    centers = rng.integers(-200, 200, size=(30, 16))
    x = (centers[rng.integers(0, 30, 3000)] + rng.integers(-8, 9, size=(3000, 16))).astype(np.int64)
    pivots = centroids.spread_pivots(centers.astype(np.int64), 8)
    best, least, measured = centroids.Assigner(centers.astype(np.int64), pivots).nearest(x, centroids.pivot_distances(x, pivots))
    full = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (least == full.min(axis=1)).all()
    assert measured < 0.2 * full.size


@pytest.mark.parametrize("name", ["op12_centroid_clustering"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, DATA).toPandas()
    key = sorted(got.columns)
    assert key == sorted(want.columns)
    assert sorted(got[key].itertuples(index=False, name=None)) == sorted(want[key].itertuples(index=False, name=None))


# Operator 13


def plainly_balanced(lengths, capacities, linear):
    """The same rule, looking at every sequence for every document."""
    room, spent, placed, rest = list(capacities), [0] * len(capacities), [], []
    cost = lambda n: linear * n + n * n

    def put(d, start, n, s):
        placed.append((d, start, n, s, capacities[s] - room[s]))
        room[s] -= n
        spent[s] += cost(n)

    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        fit = [(spent[s], s) for s in range(len(room)) if room[s] >= lengths[d]]
        put(d, 0, lengths[d], min(fit)[1]) if fit else rest.append(d)
    over = []
    for d in rest:
        start = 0
        while start < lengths[d] and any(room):
            s = min((spent[s], s) for s in range(len(room)) if room[s])[1]
            n = min(room[s], lengths[d] - start)
            put(d, start, n, s)
            start += n
        if start < lengths[d]:
            over.append((d, start))
    return placed, over


def test_balanced_packing_equals_the_plain_rule():
    rng = random.Random(9)
    for _ in range(400):
        cap = rng.choice([8, 16, 32])
        lengths = [rng.randint(1, cap - 1) for _ in range(rng.randint(0, 30))]
        full, more = divmod(sum(lengths), cap)
        capacities = [cap] * full + rng.choice([[], balanced_packing.powers(more)])
        linear = rng.choice([0, 1, 50])
        assert balanced_packing.balanced(lengths, capacities, linear) == plainly_balanced(lengths, capacities, linear)


def check_pieces(rows, texts, capacity):
    library = Tokenizer.from_file(WORD)
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc, text in texts.items():
        ids, at = [*library.encode(text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # a power of two: no padding
    return by_seq


def test_balanced_documents_round_trip(spark):
    texts = dict(enumerate(r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()))
    edge = [None, "", " \n", "a", "x " * 30_000, "é" * 3000, "1" * 9000, "日本語 text", "  "]
    texts |= {10_000 + i: t for i, t in enumerate(edge)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("offset", F.lit(1))
    tokens = {}
    for window in (balanced_packing.WINDOW_TOKENS, 9000):  # one window, and many that hand their rests on
        rows = balanced_packing.pack_balanced(docs.coalesce(1), WORD, 4096, window=window).collect()
        by_seq = check_pieces(rows, texts, 4096)
        assert sum(sum(r.length for r in own) < 4096 for own in by_seq.values()) <= 12
        tokens[window] = sum(r.length for r in rows)
    assert len(set(tokens.values())) == 1
    assert check_pieces(balanced_packing.pack_balanced(docs.repartition(3), WORD, 1024).collect(), texts, 1024)
    assert balanced_packing.pack_balanced(docs.limit(0), WORD).count() == 0


def test_repeated_rows_and_null_ids_are_documents_of_their_own(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 5 + [(None, "d e")] * 3, "doc_id long, text string")
    rows = balanced_packing.pack_balanced(docs, WORD).collect()
    assert sum(r.length for r in rows) == 5 * 4 + 3 * 3
    assert sum(r.length for r in rows if r.doc_id is None) == 9


def test_costs_are_more_even_than_first_fit():
    rng = random.Random(10)
    lengths = [min(4095, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(4000)]
    full, more = divmod(sum(lengths), 4096)
    placed, _ = balanced_packing.balanced(lengths, [4096] * full + balanced_packing.powers(more))
    spent, cut = collections.Counter(), collections.Counter()
    for doc, _, n, s, _ in placed:
        cut[doc] += 1
        if s < full:
            spent[s] += balanced_packing.cost(n)
    rooms, first_fit = [], []
    for n in sorted(lengths, reverse=True):
        s = next((s for s, room in enumerate(rooms) if room >= n), len(rooms))
        if s == len(rooms):
            rooms.append(4096)
            first_fit.append(0)
        rooms[s] -= n
        first_fit[s] += balanced_packing.cost(n)
    assert np.std([spent[s] for s in range(full)]) < 0.9 * np.std(first_fit[:-1])
    assert sum(v > 1 for v in cut.values()) < 0.05 * len(lengths)


# Operator 8: learning of transitions, and long texts


def test_expected_transitions_equal_enumeration():
    rng = np.random.default_rng(1)
    for lengths in ([5], [1], [2, 3, 1]):
        scores, moves = rng.normal(size=(sum(lengths), 3)), rng.normal(size=(3, 3))
        want, shares, at = np.zeros((3, 3)), [], 0
        for n in lengths:
            own, word = np.zeros((3, 3)), np.zeros((n, 3))
            total = 0.0
            for before in range(3):
                for path in np.ndindex(*(3,) * n):
                    p = np.exp(sum(scores[at + t, s] for t, s in enumerate(path)) + moves[before, path[0]] + sum(moves[a, b] for a, b in zip(path, path[1:])))
                    total += p
                    for a, b in zip((before, *path), path):
                        own[a, b] += p
                    for t, s in enumerate(path):
                        word[t, s] += p
            want += own / total
            shares.append(word / total)
            at += n
        probs, pairs = language_id.expectations(scores, np.array(lengths), moves)
        assert np.allclose(pairs, want) and np.allclose(probs, np.concatenate(shares))


def test_a_long_text_in_parts_equals_the_whole():
    rng = np.random.default_rng(2)
    table, moves, rows = rng.normal(size=(50, 4)), rng.normal(size=(4, 4)), rng.integers(0, 50, 5000)
    whole = language_id.marginals(table[rows], np.array([len(rows)]), moves).mean(axis=0)
    for part in (137, 1000, 5000, 9999):
        assert np.allclose(language_id.mean_marginals(table, rows, moves, part), whole)


def test_switched_texts_are_labelled_word_by_word():
    rng = random.Random(13)
    words = {"xx": ["bab", "abba", "babab"], "yy": ["zoz", "ozzo", "zozoz"]}
    model = language_id.fit([(lang, [rng.choice(own) for _ in range(30)]) for lang, own in words.items() for _ in range(60)])
    off = model.moves[0, 1] + model.moves[1, 0]
    assert off < model.moves[0, 0] + model.moves[1, 1]  # staying is likelier, switching isn't ruled out
    labeller = language_id.Labeller(model)
    rows = labeller._rows("bab abba babab bab zoz ozzo zoz zozoz")
    probs = language_id.marginals(labeller._scores()[rows], np.array([8]), model.moves)
    assert [model.labels[k] for k in probs.argmax(axis=1)] == ["xx"] * 4 + ["yy"] * 4


def test_long_texts_are_not_learned_from_but_labelled(spark):
    texts = ["the cat and the dog " * 3] * 40 + ["le chat et le chien " * 3] * 40 + ["the cat " * 60_000, "le chien " * 130_000]
    docs = spark.createDataFrame([(i, t, "fr" if t.startswith("le") else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    sample = language_id.training_sample(docs)
    assert sample.agg(F.max(F.length("text"))).first()[0] <= language_id.MAX_TEXT_CHARS and sample.count() > 40
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert got[80] == "en" and got[81] == "fr"


# Operator 4: rows, not ids


def test_every_row_is_a_query_and_a_candidate_of_the_others(spark, monkeypatch):
    from tidemark.llm import topk

    monkeypatch.setattr(topk, "CELL_ROWS", 8)
    monkeypatch.setattr(topk, "HELD_ROWS", 40)
    rng = np.random.default_rng(3)
    rows = [(i % 120, rng.normal(size=4).round(2).tolist()) for i in range(400)] + [(50, [1.0, 0.0, 0.0, 0.0]), (50, [0.5, 0.5, 0.0, 0.0])] + [(100, [2.0, 0.0, 0.0, 0.0])] * 7 + [(0, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("v", "far", "pivot", "row", "times", "cell"):
        df = df.withColumn(name, F.lit(1))
    got = collections.Counter(map(tuple, topk.top_k(df, 50, 5).collect()))
    whole = [(i, np.floor(256 * np.array((*v, *[0.0] * (4 - len(v))))).astype(np.int64)) for i, v in rows]
    want = collections.Counter()
    for n, (q, a) in enumerate(whole):
        if q % 50 == 0:
            best = sorted(((x, int(a @ b)) for m, (x, b) in enumerate(whole) if m != n), key=lambda p: (-p[1], p[0]))[:5]
            want.update((q, rank, x, s) for rank, (x, s) in enumerate(best, 1))
    assert got == want
    pair = spark.createDataFrame([(50, [1.0]), (50, [2.0]), (1, [3.0]), (2, [4.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(pair, 50, 5).collect())) == sorted([(50, 1, 2, 262144), (50, 2, 1, 196608), (50, 3, 50, 131072), (50, 1, 2, 524288), (50, 2, 1, 393216), (50, 3, 50, 131072)])
