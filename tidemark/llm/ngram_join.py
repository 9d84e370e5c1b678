"""Jaccard self-join over five-word shingles by universe partition (operator 7).

Texts with one shingle set are one record. Each record is cut into hashed segments
(``shingles.Bands``); its segment subsets, in bands of short sets also the subsets
with one shingle deleted, are the index keys. Then, all in Spark:

* a record whose segments differ from everybody else's by more than a link allows has
  no partner and is dropped with all its keys. Most keys belong to one record only, so
  this leaves near copies and little else, also where a passage is in many documents;
* one record of each key, first the best connected one, is compared with the others.
  Copies soon hang together, however many there are, without listing their pairs. This
  is repeated with other records while it finds links and listing would still take too
  many, and left out where listing takes few from the start;
* keys whose records still lie in different groups are peeled again, now counting only
  other groups' records, and each record that remains takes its cheapest keys, just
  as many as the bound asks for, and meets the other groups' records there. Of these
  pairs only such are made whose parity bitmaps differ in no more bits than the sets
  may differ in shingles.

A key that a large part of the records share is found in a sample beforehand; its rows
are dealt to many tasks, each key's counts are put together from theirs. The sample
decides only where rows meet, never which.

Every comparison intersects the two whole sets. Shingles and sets are told apart by
64-bit hashes. The result is whole: no key, record or pair is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize
from tidemark.llm.components import components
from tidemark.llm.shingles import BAND_AT, PARITY_WORDS, PART_AT, RECORD, SIZE_AT, Bands, mix, parity, set_id, shingle_set, word_hashes

#: Rounds of comparing with one record of each key end when a round leaves more than
#: this part of the rows, or after so many.
STAR_GAIN, STAR_ROUNDS = 0.9, 8
#: Rows of a key that each of its rows meets, on average, where all pairs are listed without such rounds.
LIST_ROWS = 4
#: Index keys that a task sends at once, about.
KEY_ROWS = 100_000
#: Candidates of one record in such a round; what they miss is left for the last step.
STAR_TRIES = 3
#: Rows of a key that meet all others of it in one task, about.
SALT_ROWS = 4096
#: Frequent keys are sought in this part of the documents, at most about so many; one that
#: so many of them have is dealt to ``HOT_SALTS`` tasks. At most ``HOT_KEYS``, the most
#: frequent ones, are dealt, so they can be broadcast; others meet in one task each.
HOT_PART, HOT_SAMPLE, HOT_HITS, HOT_SALTS, HOT_KEYS = 0.02, 20_000, 20, 64, 100_000
#: 64-bit words of the filter that spares sending texts without candidates through a shuffle.
FILTER_WORDS = 1 << 19


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _index_rows(docs: DataFrame) -> DataFrame:
    """(sig, rec, tag, doc_id): a row of each document, in band ``RECORD``, and the index keys of each set, once a task.

    Texts are read once for both. A document's row has a ``sig`` of its own, so that no
    set, however often it comes, meets in one task.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands, seen, count = word_hashes(), Bands(), {}, 0
        names = ["sig", "rec", "tag", "doc_id"]

        def key_rows(out: list[tuple]) -> pa.RecordBatch:
            keys = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
            return pa.RecordBatch.from_arrays([*keys, pa.nulls(len(keys[0]), pa.int64())], names)

        for batch in batches:
            out: list[tuple] = []
            recs, tags, held = [], [], 0
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text, hashes)
                rec, n = set_id(tokens), len(tokens)
                if n and (rec, n) not in seen:
                    sig, tag, seen[rec, n] = bands.signatures(tokens)
                    out.append((sig.view(np.int64), np.full(len(sig), rec), tag))
                    held += len(sig)
                    if held >= KEY_ROWS:
                        yield key_rows(out)
                        out, held = [], 0
                recs.append(rec)
                tags.append(n << SIZE_AT | RECORD << BAND_AT | seen.get((rec, n), False) << PART_AT)
            recs = np.array(recs, dtype=np.int64)
            sig = mix(recs.view(np.uint64) + mix(np.arange(count, count + len(recs), dtype=np.uint64) + np.uint64(1))).view(np.int64)
            count += len(recs)
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(recs), pa.array(tags, pa.int64()), batch.column(0)], names)
            if out:
                yield key_rows(out)

    return _texts(docs).mapInArrow(emit, "sig long, rec long, tag long, doc_id long")


def _field(at: int, bits: int) -> Column:
    return F.shiftright("tag", at).bitwiseAND((1 << bits) - 1)


def _with_bounds(rows: DataFrame) -> DataFrame:
    """Adds ``spare``: by how much the record's differing segments may fall short before it can have a partner."""
    bands = Bands()
    at = F.col("band").cast("int") + 1
    hi, m, wide = (F.get(F.array(*map(F.lit, x)), at - 1) for x in (bands.edges[1:], bands.segments, bands.wide))
    most = F.when(F.col("n") >= hi, F.expr("1L") * F.floor((F.col("n") + hi - 1) / 9)).otherwise(F.floor(F.col("n") / 4))
    total = F.when(wide, 2 * m).otherwise(F.when(at == 1, F.lit(1)).otherwise(m - F.col("part")))
    return rows.withColumn("spare", (total - most).cast("long")).withColumn("wide", wide)


def _hot_keys(docs: DataFrame) -> DataFrame | None:
    """(sig) of the keys that many of a sample's records have, None where there are none; bounded by ``HOT_KEYS``."""
    part = min(HOT_PART, HOT_SAMPLE / max(1, docs.count()))
    found = _index_rows(docs.sample(part, seed=7)).groupBy("sig").count().filter(F.col("count") >= HOT_HITS)
    found = materialize(found.orderBy(F.desc("count"), "sig").limit(HOT_KEYS).select("sig"), "hot")
    if found.isEmpty():
        discard(found)
        return None
    return found


def _key() -> Column:
    """One number for (sig, salt): rows are sorted by it faster than by both. Keys that fall together are met by more rows, which is safe."""
    return F.when(F.col("salt") > 0, F.xxhash64("sig", "salt")).otherwise(F.col("sig"))


def _dealt(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Adds ``salt``, 0 but for frequent keys, and brings rows of one (sig, salt) together."""
    if hot is None:
        return rows.repartition("sig").withColumn("salt", F.lit(0))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("rec"), F.lit(HOT_SALTS)).cast("int") + 1).otherwise(0)
    marked = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "sig", "left")
    return marked.withColumn("salt", salt).drop("hot").repartition(_key())


def _extent() -> dict[str, Column]:
    """What must be known of a key's rows: the groups they lie in, by kind, and their number."""
    full, cut = F.when(F.col("kind") == 0, F.col("comp")), F.when(F.col("kind") == 1, F.col("comp"))
    return {"f0": F.min(full), "f1": F.max(full), "c0": F.min(cut), "c1": F.max(cut), "rows": F.count("*")}


def _near() -> Column:
    """How the rows of another group meet this one, from the key's extent: 2 fully, 1 by a deletion, null not at all."""
    other = lambda a, b: F.coalesce((F.col(a) != F.col("comp")) | (F.col(b) != F.col("comp")), F.lit(False))
    return F.when((F.col("kind") == 0) & other("f0", "f1"), 2).when(other("f0", "f1") | ((F.col("kind") == 0) & other("c0", "c1")), 1)


def _met(rows: DataFrame) -> DataFrame:
    """Rows whose key is met by another group's (``near`` and ``rows`` say how), and documents' own, written.

    Rows of frequent keys are all kept; ``_hot_met`` decides on them.
    """
    key = Window.partitionBy(_key())
    met = rows.drop("ties", "rows").select("*", *(c.over(key).alias(name) for name, c in _extent().items())).withColumn("near", _near())
    met = met.filter((F.col("band") == RECORD) | F.col("near").isNotNull() | (F.col("salt") > 0))
    return materialize(met.drop("f0", "f1", "c0", "c1"), "met")


def _hot_met(met: DataFrame, dealt: bool) -> tuple[DataFrame, DataFrame | None]:
    """``met``, where keys were ``dealt`` with the rows of frequent keys judged by the whole key, and the table for that.

    A key's rows are summed up in each task first; the table has one row a key, ``HOT_KEYS`` at most.
    """
    if not dealt:
        return met, None
    extent = met.filter("salt > 0").groupBy("sig").agg(*(c.alias(name) for name, c in _extent().items()))
    extent = materialize(extent.withColumnRenamed("rows", "all_rows"), "extent")
    whole = F.col("salt") > 0
    judged = met.join(F.broadcast(extent), "sig", "left").withColumn("near", F.when(whole, _near()).otherwise(F.col("near")))
    judged = judged.withColumn("rows", F.when(whole, F.col("all_rows")).otherwise(F.col("rows"))).filter("near is not null")
    return judged.drop("f0", "f1", "c0", "c1", "all_rows"), extent


def _able(met: DataFrame, dealt: bool, once: bool = False) -> DataFrame:
    """Rows of records that differ from the groups they meet by no more than a link allows; with ``once``, each key of a record once."""
    met, extent = _hot_met(met, dealt)
    met = met.repartition("rec", "n", "band")  # serves both sums and the join
    place = F.when(F.col("wide"), F.col("part")).otherwise(F.col("sig")).alias("place")
    by_place = met.groupBy("rec", "n", "band", place).agg(
        F.max(F.when(F.col("wide"), F.col("near")).otherwise(1)).alias("lost"), F.max("spare").alias("spare"), F.sum("rows").alias("rows")
    )
    able = by_place.groupBy("rec", "n", "band").agg(F.sum("lost").alias("lost"), F.max("spare").alias("spare"), F.sum("rows").alias("ties"))
    able = able.filter("lost >= spare").select("rec", "n", "band", "ties")
    keys = met.drop("near").join(able.hint("shuffle_hash"), ["rec", "n", "band"])  # one row a record, so no sort of the keys
    if once:
        keys = keys.dropDuplicates(["rec", "n", "band", "sig", "salt", "part", "kind"])
    keys = materialize(keys, "keys")
    if extent is not None:
        discard(extent)
    return keys


def _peel(rows: DataFrame, dealt: bool, passes: int, once: bool = False) -> DataFrame:
    """Rows of records that can have a partner in another group (``comp``), with the keys' other records only.

    Each pass is exact; a pass may leave others with less, so there may be more. ``ties``
    says how many rows share the record's keys.
    """
    for _ in range(passes):
        met = _met(rows)
        discard(rows)
        rows = _able(met, dealt, once)
        discard(met)
    return rows


def _load(rows: DataFrame) -> tuple[int, bool]:
    """The number of rows, and whether listing all pairs takes few enough for each."""
    held, met = rows.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    return held, met <= LIST_ROWS * held


def _with_key(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """``rows`` with the one row that ``keyed`` has of their key; the rows of a dealt key stay in the tasks that they were dealt to."""
    dealt = rows.filter("salt > 0").select("sig", "salt").distinct()
    spread = keyed.withColumn("salt", F.lit(0).cast(rows.schema["salt"].dataType)).unionByName(dealt.join(keyed, "sig"))
    return rows.join(spread, ["sig", "salt"])


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each record with the records that come first in the most of its keys."""
    rank = F.when(F.lit(turn == 0), -F.col("ties")).otherwise(F.lit(0))
    who = F.struct(rank.alias("rank"), F.xxhash64("rec", F.lit(turn)).alias("order"), "rec", "n", "comp")
    least = rows.filter("kind = 0").groupBy("sig").agg(F.min(who).alias("least"))
    pairs = (
        _with_key(rows, least)
        .filter("least.comp <> comp and 5 * least(n, least.n) >= 4 * greatest(n, least.n)")
        .groupBy(F.col("least.rec").alias("a"), F.col("least.n").alias("na"), F.col("rec").alias("b"), F.col("n").alias("nb"))
        .agg(F.count("*").alias("keys"))
    )
    best = F.row_number().over(Window.partitionBy("b", "nb").orderBy(F.desc("keys"), "a", "na"))
    return pairs.withColumn("try", best).filter(F.col("try") <= STAR_TRIES).select("a", "na", "b", "nb")


def _rest_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of different groups that share a key which one of them needs and that bitmaps don't rule out.

    The pairs of a frequent key are dealt into several tasks.
    """
    costs = rows.groupBy("sig").agg(F.count("*").alias("cost"))
    rows = _with_key(rows, costs).drop("salt").join(sets.select("rec", "n", "bits"), ["rec", "n"])
    cheap = F.row_number().over(Window.partitionBy("rec", "n", "band").orderBy("cost", "sig"))
    held = F.count("*").over(Window.partitionBy("rec", "n", "band"))
    rows = rows.withColumn("salts", F.ceil(F.col("cost") / SALT_ROWS).cast("int"))
    # Of the keys that others share too, as many may be left out as are spare.
    needed = rows.withColumn("cheap", cheap).withColumn("held", held)
    needed = needed.filter(F.col("wide") | (F.col("cheap") <= F.col("held") - F.col("spare") + 1) | (F.col("spare") <= 0))
    side = lambda r, n, c, k, x: (F.col("rec").alias(r), F.col("n").alias(n), F.col("comp").alias(c), F.col("kind").alias(k), F.col("bits").alias(x))
    x = needed.select("sig", F.pmod(F.xxhash64("rec"), F.col("salts")).cast("int").alias("salt"), *side("a", "na", "ca", "ka", "xa"))
    y = rows.select("sig", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *side("b", "nb", "cb", "kb", "xb"))
    met = x.join(y, ["sig", "salt"]).filter("ca <> cb and ka + kb < 2 and 5 * least(na, nb) >= 4 * greatest(na, nb)")
    apart = " + ".join(f"bit_count(xa[{i}] ^ xb[{i}])" for i in range(PARITY_WORDS))
    met = met.filter(f"9 * ({apart}) <= na + nb")
    first = F.expr("a < b or (a = b and na < nb)")
    swap = [F.when(first, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in (("a", "b"), ("na", "nb"), ("b", "a"), ("nb", "na"))]
    return met.select(*swap).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least 0.8, and how much they have in ``common``."""
    x, y = (sets.select(F.col("rec").alias(r), F.col("n").alias(n), F.col("tokens").alias(t)) for r, n, t in (("a", "na", "x"), ("b", "nb", "y")))
    both = pairs.join(y, ["b", "nb"]).join(x, ["a", "na"])
    met = both.select("a", "na", "b", "nb", F.size(F.array_intersect("x", "y")).alias("common"))
    return met.filter("100 * common >= 80 * (na + nb - common)")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs that link."""
    return _verified(pairs, sets).select("a", "b").distinct()


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rec, n, tokens, bits) of the wanted records (rec, n, doc_id), one row each.

    A fixed-size bit filter over document ids keeps texts without a candidate where
    they are; it lets some through that needn't be, never the reverse.
    """
    spark = docs.sparkSession
    bits = FILTER_WORDS * 64
    spots = lambda: F.array(*(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(bits)) for k in (1, 2)))
    marked = wanted.select(F.explode(spots()).alias("spot"))
    words = marked.groupBy(F.shiftright("spot", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))).alias("bits")
    )
    table = np.zeros(FILTER_WORDS, dtype=np.int64)
    found = words.toArrow()  # FILTER_WORDS rows at most
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    del found
    shared = spark.sparkContext.broadcast(table)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = word_hashes(), shared.value
        for batch in batches:
            hit = np.ones(batch.num_rows, dtype=bool)
            for k in (1, 2):
                spot = batch.column(k).to_numpy()
                hit &= (bits[spot >> 6] >> (spot & 63)) & 1 == 1
            rows = [(shingle_set(batch.column(3)[int(i)].as_py(), hashes), batch.column(0)[int(i)].as_py()) for i in np.flatnonzero(hit)]
            rows = [(doc, set_id(s), len(s), s.view(np.int64), parity(s)) for s, doc in rows]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "rec", "n", "tokens", "bits"])

    texts = _texts(docs).filter("doc_id is not null").select("doc_id", F.element_at(spots(), 1), F.element_at(spots(), 2), "text")
    sets = texts.mapInArrow(fetch, "doc_id long, rec long, n long, tokens array<long>, bits array<long>")
    sets = sets.join(wanted, ["doc_id", "rec", "n"], "left_semi").groupBy("rec", "n").agg(F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
    sets = materialize(sets, "sets")
    shared.destroy()
    return sets


@dataclass
class _Join:
    """What both results start from; all but ``recs`` and ``direct`` are written tables."""

    of_docs: DataFrame
    recs: DataFrame
    rows: DataFrame
    #: Whether frequent keys are dealt to several tasks.
    dealt: bool
    sets: DataFrame
    #: Pairs of sets that the bands can't decide on, None where there are none.
    direct: DataFrame | None


def _prepare(docs: DataFrame) -> _Join:
    # Shuffle the narrow rows; what follows from the tag is worked out after it.
    hot = _hot_keys(docs)
    dealt = hot is not None
    rows = _dealt(_index_rows(docs), hot).select(
        "sig", "salt", "rec", "tag", "doc_id", F.shiftright("tag", SIZE_AT).alias("n"), _field(BAND_AT, 6).alias("band"),
        _field(PART_AT, BAND_AT - PART_AT).alias("part"), F.col("tag").bitwiseAND(1).alias("kind"), F.col("rec").alias("comp"),
    )
    met = _met(_with_bounds(rows).drop("tag"))
    of_docs = materialize(met.filter(F.col("band") == RECORD).select("doc_id", "rec", "n", (F.col("part") == 1).alias("overflow")), "records")
    rows = _able(met.filter(F.col("band") != RECORD).drop("doc_id"), dealt)
    discard(met)
    if dealt:
        discard(hot)
    rows = _peel(rows, dealt, 1, once=True)
    recs = of_docs.filter("n > 0").groupBy("rec", "n").agg(F.min("doc_id").alias("doc_id"), F.bool_or("overflow").alias("overflow"))
    loose = materialize(recs.filter("overflow"), "loose")
    wanted = rows.select("rec", "n").distinct().join(recs.drop("overflow"), ["rec", "n"])
    direct = None
    if loose.limit(1).count():
        near = recs.select(F.col("rec").alias("b"), F.col("n").alias("nb"))
        low, high = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))), F.floor(F.log(F.col("nb").cast("double")) / F.log(F.lit(1.25)))
        direct = loose.select(F.col("rec").alias("a"), F.col("n").alias("na"), F.explode(F.array(low - 1, low, low + 1)).alias("level"))
        direct = direct.join(near.withColumn("level", high), "level").filter("a <> b and 5 * least(na, nb) >= 4 * greatest(na, nb)")
        direct = materialize(direct.select("a", "na", "b", "nb").distinct(), "direct")
        more = direct.select(F.explode(F.array(F.struct(F.col("a").alias("rec"), F.col("na").alias("n")), F.struct(F.col("b").alias("rec"), F.col("nb").alias("n")))).alias("r")).select("r.*")
        wanted = wanted.unionByName(more.distinct().join(recs.drop("overflow"), ["rec", "n"])).distinct()
    discard(loose)
    wanted = materialize(wanted, "wanted")
    sets = _sets_of(docs, wanted)
    discard(wanted)
    return _Join(of_docs, recs, rows, dealt, sets, direct)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    The component is the smallest doc_id reachable over links of similarity 0.8 or
    more. A null, empty or blank text has no shingles and no links. Rows without a
    doc_id link like others, but name no component, and are compared only through
    equal sets that have one. Equal rows stay rows of one component. No rows, no result.
    """
    start = _prepare(docs)
    recs, rows, sets = start.recs, start.rows, start.sets
    links = materialize(_verify(start.direct, sets), "links") if start.direct else None
    groups = components(links) if links else None
    turn, stuck, (held, listed) = 0, False, _load(rows)  # stuck: a round found no link, so groups and rows stay as they are
    while held:
        if groups is not None and not stuck:
            grouped = groups.select(F.col("node").alias("rec"), F.col("component").alias("g"))
            grouped = materialize(rows.join(grouped, "rec", "left").withColumn("comp", F.coalesce("g", "comp")).drop("g"), "grouped")
            discard(rows)
            rows = _peel(grouped, start.dealt, 2)
            before, (held, few) = held, _load(rows)
            if not held:
                break
            listed = few or held > STAR_GAIN * before or turn == STAR_ROUNDS
        listed |= stuck
        new = materialize(_verify(_rest_pairs(rows, sets) if listed else _star_pairs(rows, turn), sets), "links")
        stuck = new.isEmpty()
        if not stuck:
            links = new if links is None else links.unionByName(new)
            if groups is not None:
                discard(groups)
            groups = components(links)
        turn += 1
        if listed:
            break
    discard(rows)
    discard(sets)
    if groups is not None:
        linked = groups.join(recs, groups["node"] == recs["rec"]).select("rec", "n", "component", "doc_id")
        least = linked.groupBy("component").agg(F.min("doc_id").alias("least"))
        recs = recs.join(linked.join(least, "component").select("rec", "n", "least"), ["rec", "n"], "left")
        recs = recs.withColumn("doc_id", F.coalesce("least", "doc_id"))
    named = recs.select("rec", "n", F.col("doc_id").alias("component"))
    return start.of_docs.join(named, ["rec", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links between different texts, (a, b, common, n_a, n_b), and the members (doc_id, rep) of each text.

    Equal sets are one text, named by its smallest doc_id; a is the smaller name. Every
    pair of a similarity of 0.8 or more is there once, so the table grows with the square
    of a group of different near copies; ``near_copies`` doesn't list them. Texts without
    words have no links and are their own members; rows without a doc_id name no text.
    """
    start = _prepare(docs)
    pairs = _rest_pairs(start.rows, start.sets)
    if start.direct:
        first = F.expr("a < b or (a = b and na < nb)")
        swap = [F.when(first, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in (("a", "b"), ("na", "nb"), ("b", "a"), ("nb", "na"))]
        pairs = pairs.unionByName(start.direct.select(*swap)).distinct()
    found = _verified(pairs, start.sets)
    name = lambda r, n, d: start.recs.select(F.col("rec").alias(r), F.col("n").alias(n), F.col("doc_id").alias(d))
    found = found.join(name("a", "na", "da"), ["a", "na"]).join(name("b", "nb", "db"), ["b", "nb"])
    ahead = F.col("da") < F.col("db")
    links = found.select(
        F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b"), "common",
        F.when(ahead, F.col("na")).otherwise(F.col("nb")).alias("n_a"), F.when(ahead, F.col("nb")).otherwise(F.col("na")).alias("n_b"),
    )
    reps = start.recs.select("rec", "n", F.col("doc_id").alias("rep"))
    return links, start.of_docs.join(reps, ["rec", "n"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
