"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are made in one pass over the texts. Equal fingerprints collapse to one node. Blocking tables put nodes
that agree on some bits into one bucket; a bucket of more than ``block`` nodes is cut into blocks, and each pair of
blocks is a unit of work, so that no task gets a whole hot bucket. In a unit, the bit planes of up to 64 nodes lie in one
word each: a query's bit against a plane is one XOR for 64 distances, added into vertical carry-save counters, and a word
is abandoned once all its lanes exceed the radius. A unit returns a spanning forest of its links, never all pairs.

A plan with a similarity links by the Jaccard similarity of the sets of shingles. Its fingerprints, compared in the same
way, propose the links and the sets confirm them. Fingerprints alone miss similar pairs, so sets that are not connected
by then meet once more: two similar sets share a shingle of their prefixes in any common order, here the rarest first.
Where many sets share one, each meets a few of them first, which connects large groups of near copies; then all meet that
are not connected yet.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import LOWER_ASCII, bookmark, checkpointed, discard, fresh, frugal, released, stored, trimmed
from meridian.llm.components import components

SEED = 42


@dataclass(frozen=True)
class Plan:
    """words: per shingle. bits: of a fingerprint, a multiple of 64. radius: the most differing bits of a link.

    tables and key_bits: 0 for the exact blocking by pigeonholes (quarters of the fingerprint, two of which agree when
    at most two bits differ), else that many tables of as many sampled bits. block: nodes in a block of a bucket.
    similarity: of a link at least, where it is given; the other fields then say which links fingerprints propose, and
    key_bits is the least, more on large tables.
    """

    words: int = 3
    bits: int = 64
    radius: int = 2
    tables: int = 0
    key_bits: int = 0
    block: int = 512
    similarity: float = 0.0

    def chosen(self) -> list[np.ndarray]:
        """The bits that each table compares."""
        if self.tables:
            rng = np.random.default_rng(SEED)
            return [np.sort(rng.choice(self.bits, self.key_bits, replace=False)) for _ in range(self.tables)]
        if self.radius > 2:
            raise ValueError("quarters find links of 2 bits at most; give tables and key_bits")
        quarter = self.bits // 4
        return [np.concatenate([np.arange(q * quarter, (q + 1) * quarter) for q in two]) for two in itertools.combinations(range(4), 2)]


#: op2: three words, 64 bits, 2 bits apart at most.
CONTRACT = Plan()
#: Five words, a Jaccard similarity of 0.8 or more. At 0.8 fingerprints differ in 19 of 128 bits on average.
NEAR_DEDUP = Plan(words=5, bits=128, radius=28, tables=32, key_bits=16, similarity=0.8)
#: Shingles are counted in a sample of so many texts, or half of them; so many of the most common ones go last in the order of prefixes.
SAMPLE, MOST_COMMON = 20_000, 200_000
#: Of sets that share a shingle of their prefixes, if there are more than LARGE, STARS meet all others; a set is compared with MEETINGS of those it met.
LARGE, STARS, MEETINGS = 8, 8, 16
#: So many names of sets are broadcast at most.
FEW = 1_000_000
#: Slack of comparisons with a product of the similarity.
EPS = 1e-9
#: What of a set tells whether it can be similar to another.
TOLD = ("size", "p0", "p1", "p2", "p3")


def _mixed(h: np.ndarray, lanes: int) -> np.ndarray:
    """(n,) hashes -> (n, lanes): the hash, then further ones mixed from it."""
    out = [h]
    for k in range(1, lanes):
        z = h + np.uint64((0x9E3779B97F4A7C15 * k) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(z ^ (z >> np.uint64(31)))
    return np.stack(out, axis=1)


def _ones(h: np.ndarray) -> np.ndarray:
    """(n, lanes) hashes -> how many have each bit. Bytes are summed in runs of 255, which cannot overflow."""
    total = np.zeros(h.shape[1] * 64, dtype=np.int64)
    for at in range(0, len(h), 255 * 64):
        bits = np.unpackbits(np.ascontiguousarray(h[at : at + 255 * 64]).view(np.uint8).reshape(-1, h.shape[1] * 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            total += bits[:whole].reshape(-1, 255, bits.shape[1]).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        if whole < len(bits):
            total += bits[whole:].sum(axis=0, dtype=np.uint8)
    return total


def shingles(text: str | None, k: int) -> np.ndarray:
    """The hashes of a text's runs of k words (of all its words, where they are fewer); none without words."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER_ASCII).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = [0, *ends[:-1].tolist()], (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, stops[k - 1 :]) if len(words) > k else ((0, len(joined)),)
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, plan: Plan = CONTRACT) -> np.ndarray:
    """The fingerprint's words, least significant first; zero for a text without words (null: none)."""
    h = shingles(text, plan.words)
    if not len(h):
        return np.zeros(plan.bits // 64, dtype=np.uint64)
    ones = _ones(_mixed(h, plan.bits // 64))
    return np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, plan: Plan = CONTRACT) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp binary: most significant byte first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            fps = [fingerprint(t, plan).tobytes()[::-1] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp binary")


def _unpacked(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps, axis=1, bitorder="little")


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _bucketed(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(fp) -> (bucket long, fp): a row for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        chosen = plan.chosen()
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = _unpacked(_rows(batch.column(0), plan.bits // 8)).astype(np.int64)
            for t, at in enumerate(chosen):
                key = bits[:, at] @ (1 << np.arange(len(at), dtype=np.int64)) | (t << 40)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], ["bucket", "fp"])

    return nodes.select("fp").mapInArrow(run, "bucket long, fp binary")


def _planes(bits: np.ndarray) -> np.ndarray:
    """(bits, words * 64) of 0/1 -> (bits, words): bit b of 64 nodes as one word."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def within_radius(bits: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, planes: np.ndarray, radius: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Bit-sliced distances of items (query[i], word[i]); lanes[i]: the word's lanes that count.

    bits (bits, nodes) and planes (bits, words) hold a plane in each row.
    Returns the item indexes with any lane within the radius, and those lanes. After every ``step`` planes the
    lanes beyond the radius are struck out and items without lanes are abandoned.
    """
    width = (radius + step).bit_length()
    item, counters = np.arange(len(query)), [np.zeros(len(query), np.uint64) for _ in range(width)]
    for at in range(0, len(bits), step):
        for b in range(at, min(at + step, len(bits))):
            carry = planes[b][word] ^ (np.uint64(0) - bits[b][query].astype(np.uint64))
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
        above, equal = np.zeros(len(item), np.uint64), np.full(len(item), 2**64 - 1, np.uint64)
        for k in reversed(range(width)):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                above |= equal & counters[k]
                equal &= ~counters[k]
        lanes = lanes & ~above
        if (live := lanes != 0).sum() < 0.9 * len(live):
            item, query, word, lanes, counters = item[live], query[live], word[live], lanes[live], [c[live] for c in counters]
        if not len(item):
            break
    live = lanes != 0
    return item[live], lanes[live]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each index's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _slots(sizes: np.ndarray) -> np.ndarray:
    """Where each unit begins, in lanes: small units share a word of 64, a unit that doesn't fit begins a new one."""
    out, at = np.empty(len(sizes), np.int64), 0
    for i, n in enumerate(sizes.tolist()):
        if at % 64 + n > 64:
            at = -(-at // 64) * 64
        out[i] = at
        at += n
    return out


def _apart(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits fps[a] and fps[b] differ in."""
    return np.concatenate([np.bitwise_count(fps[a[at : at + 65536]] ^ fps[b[at : at + 65536]]).sum(axis=1, dtype=np.int32) for at in range(0, len(a), 65536)] or [np.empty(0, np.int32)])


def linked(sizes: np.ndarray, fps: np.ndarray, plan: Plan, chunk: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Units of ``sizes`` nodes, one after another in fps (n, bytes): the links of a spanning forest, as indexes.

    Under a plan with a similarity each node's link to the nearest of those before it in its unit, for a check of pairs.
    """
    first, begin = np.cumsum(sizes) - sizes, _slots(sizes)
    unit = np.repeat(np.arange(len(sizes)), sizes)
    begin, first = begin[unit], first[unit]
    slot = begin + np.arange(len(fps)) - first
    bits = np.ascontiguousarray(_unpacked(fps).T)
    padded = np.zeros((plan.bits, (int(slot[-1]) // 64 + 1) * 64), dtype=np.uint8)
    padded[:, slot] = bits
    planes = _planes(padded)
    del padded
    spans = slot // 64 - begin // 64 + 1  # a node meets those of its unit before it: the words up to its own
    below = lambda n: np.where(n >= 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))
    pairs_a, pairs_b, todo, at = [], [], np.cumsum(spans), 0
    nearest = np.full(len(fps), -1, np.int64)
    while at < len(fps):
        to = max(at + 1, int(np.searchsorted(todo, (todo[at - 1] if at else 0) + chunk, "right")))
        query = np.repeat(np.arange(at, to), spans[at:to])
        nth = np.arange(len(query)) - np.repeat(np.cumsum(spans[at:to]) - spans[at:to], spans[at:to])
        word = begin[query] // 64 + nth
        low, high = np.where(nth == 0, begin[query] % 64, 0), np.where(word == slot[query] // 64, slot[query] % 64, 64)
        lanes = below(high) & ~below(low)
        keep = lanes != 0
        query, word, lanes = query[keep], word[keep], lanes[keep]
        got, alive = within_radius(bits, query, word, lanes, planes, plan.radius)
        i, lane = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        found = query[got[i]]
        partner = first[found] + word[got[i]] * 64 + lane - begin[found]
        at = to
        if plan.similarity:  # the queries of a step are in it with all their pairs
            order = np.lexsort((partner, _apart(fps, found, partner), found))
            found, partner = found[order], partner[order]
            own, where = np.unique(found, return_index=True)
            nearest[own] = partner[where]
            continue
        pairs_a.append(found)
        pairs_b.append(partner)
        if sum(map(len, pairs_a)) > 1 << 20:  # the forest so far stands for its links
            label = _forest(len(fps), np.concatenate(pairs_a), np.concatenate(pairs_b))
            kept = np.nonzero(label != np.arange(len(fps)))[0]
            pairs_a, pairs_b = [kept], [label[kept]]
    if plan.similarity:
        a = np.nonzero(nearest >= 0)[0]
        return a, nearest[a]
    a, b = np.concatenate([*pairs_a, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*pairs_b, np.empty(0, np.int64)]).astype(np.int64)
    label = _forest(len(fps), a, b)
    a = np.nonzero(label != np.arange(len(fps)))[0]
    return a, label[a]


def links(nodes: DataFrame, plan: Plan = CONTRACT) -> DataFrame:
    """(fp) distinct -> (a binary, b binary): links that connect all nodes joined by chains within the radius.

    Under a plan with a similarity each fingerprint's link to the nearest of the lesser ones that it meets.
    """
    rows = _bucketed(nodes, plan)
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").where(F.col("n") > plan.block)
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / plan.block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    units = (
        rows.join(full, "bucket", "left")
        .select("bucket", "fp", own.alias("own"), other.alias("other"))
        .groupBy("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_sort("fps").alias("fps") if plan.similarity else "fps")
    )
    most = 1 << 13

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy().astype(np.int64)
            at = 0
            while at < len(lists):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
                part = lists.values.slice(ends[at], ends[to] - ends[at])
                fps = _rows(part, plan.bits // 8)
                a, b = linked(np.diff(ends[at : to + 1]), fps, plan)
                yield pa.RecordBatch.from_arrays([part.take(pa.array(a)), part.take(pa.array(b)), pa.array(_apart(fps, a, b))], ["a", "b", "apart"])
                at = to
        trimmed()

    found = units.mapInArrow(run, "a binary, b binary, apart int")
    if plan.similarity:
        return found.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m")).select("a", "m.b")
    return found.select("a", "b").distinct()


def _digest() -> Column:
    """Tells rows that share an id apart; a null text counts as empty."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def _of_set(h: np.ndarray, plan: Plan) -> bytes:
    """The fingerprint of a set of 32-bit hashes."""
    lanes = plan.bits // 64
    ones = _ones(np.ascontiguousarray(_mixed(h.astype(np.uint64), lanes + 1)[:, 1:]))
    return np.packbits(ones * 2 > len(h), bitorder="little").tobytes()


def shingled(docs: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, text) -> (doc_id, digest of the text, node long, size int, p0 to p3 long, fp binary, shingles binary): a row's set.

    The set holds 32 bits of each shingle's hash, which halves what is stored and shuffled: of n shingles about n * n / 2**33
    fall together, one in a text of 90 000 words. node is a digest of the set, fp its fingerprint. p0 to p3: the parities of how many shingles fall in each of 256 cells; two sets differ in
    at least as many shingles as their parities differ in bits.
    """

    def told(text: str | None) -> tuple:
        h = np.unique(shingles(text, plan.words).astype(np.uint32))
        data = h.tobytes()
        parity = np.packbits(np.bincount((h & np.uint32(255)).astype(np.int64), minlength=256).astype(np.uint8) & 1, bitorder="little").view("<i8")
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True), len(h), *parity.tolist(), _of_set(h, plan), data

    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [told(t) for t in part.column(1).to_pylist()]
                made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *made], ["doc_id", "digest", "node", "size", "p0", "p1", "p2", "p3", "fp", "shingles"])

    schema = "doc_id long, digest string, node long, size int, p0 long, p1 long, p2 long, p3 long, fp binary, shingles binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _digest().alias("digest")).mapInArrow(run, schema)


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint32) for x in column.to_pylist()]


def _common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles of a sample of the sets, sorted, and their counts there."""
    n, parts = rows.count(), 1_000_003
    part = rows.where(F.pmod(F.xxhash64("node"), F.lit(parts)) < max(1, int(parts * min(1.0, max(0.5, SAMPLE / max(n, 1))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for h in _sets(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int32))], ["token"])

    counted = part.select("shingles").mapInArrow(run, "token int").groupBy("token").agg(F.count("*").alias("n")).where("n > 3")
    top = counted.orderBy(F.col("n").desc(), "token").limit(MOST_COMMON).toArrow()
    tokens, counts = (top.column(c).to_numpy() for c in ("token", "n"))
    tokens = tokens.astype(np.int32).view(np.uint32)
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def _prefixes(rows: DataFrame, similarity: float, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(token, node, size): the rarest shingles of each set, as many as two similar sets can't differ in and one more.

    A task gives a set once, however many rows have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        seen: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                own = part.column(0).to_pylist()
                part = part.filter(pa.array([x not in seen and not seen.add(x) for x in own], pa.bool_()))
                names, sizes, out = part.column(0).to_numpy(), part.column(1).to_numpy(), []
                for h in _sets(part.column(2)):
                    n = len(h) - math.ceil(len(h) * similarity - EPS) + 1 if len(h) else 0
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                        h = h[np.argsort(np.where(tokens[at] == h, counts[at], 0), kind="stable")]
                    out.append(h[:n])
                many = np.array([len(h) for h in out], np.int64)
                flat = np.concatenate([*out, np.empty(0, np.uint32)]).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(names, many)), pa.array(np.repeat(sizes, many))], ["token", "node", "size"])
        trimmed()

    return rows.select("node", "size", "shingles").mapInArrow(run, "token int, node long, size int")


def _possible(a: str, b: str, similarity: float) -> Column:
    """Whether sets can be similar by their sizes and parities, in columns that begin with ``a`` and ``b``."""
    x, y = F.col(f"{a}size"), F.col(f"{b}size")
    apart = sum((F.bit_count(F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}"))) for i in range(4)), F.lit(0))
    return (F.least(x, y) >= F.greatest(x, y) * similarity - EPS) & (apart <= (x + y) * ((1 - similarity) / (1 + similarity)) + EPS)


def _enough(similarity: float) -> Column:
    """Whether sets of ``size`` and ``b_size`` that share n shingles of their prefixes can be similar."""
    after = lambda c: F.ceil(F.col(c) * similarity - EPS) - 1  # noqa: E731 - shingles that aren't in the prefix
    # The prefix that ends first in the common order shares nothing with the other set's remainder, so at most all after it is shared too.
    return F.col("n") + F.greatest(after("size"), after("b_size")) >= (F.col("size") + F.col("b_size")) * (similarity / (1 + similarity)) - EPS


def _similar(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) distinct -> those whose sets are similar: by size, by parities, then exactly."""
    of = lambda s: nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in TOLD])
    likely = checkpointed(pairs.join(of("a"), "a").join(of("b"), "b").where(_possible("a_", "b_", similarity)).select("a", "b"))
    released(rows.sparkSession)
    wanted = checkpointed(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct())
    few = F.broadcast(wanted) if wanted.count() <= FEW else wanted  # then the other sets aren't shuffled
    sets = rows.join(few, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part, keep = batch.slice(start, 512), []
                for x, y in zip(_sets(part.column(2)), _sets(part.column(3))):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both >= (len(x) + len(y) - both) * similarity - EPS)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        trimmed()

    whole = likely.join(sets.select(F.col("node").alias("a"), F.col("h").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("h").alias("y")), "b")
    return checkpointed(whole.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def _proposed(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(node, fp) -> (a, b): links that the fingerprints propose, one at most a node."""
    least = checkpointed(nodes.groupBy("fp").agg(F.min("node").alias("least")))
    plan = replace(plan, key_bits=max(plan.key_bits, (least.count() // 8).bit_length()))
    same = nodes.join(least, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    of = lambda s: least.select(F.col("fp").alias(s), F.col("least").alias(f"{s}_node"))
    near = links(least.select("fp"), plan).join(of("a"), "a").join(of("b"), "b")
    return same.unionByName(near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def _unconnected(shared: DataFrame, near: DataFrame, nodes: DataFrame) -> DataFrame:
    """(token, node) and (node, label) -> (token, node, label, size, p0 to p3) of the tokens that several components share."""
    told = nodes.join(near, "node", "left").select("node", F.coalesce("label", "node").alias("label"), *TOLD)
    named = stored(shared.join(told, "node"), "named")
    released(shared.sparkSession)
    apart = named.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l <> m").select("token")
    return named.join(apart, "token", "left_semi")


def _others(rest: DataFrame) -> DataFrame:
    return rest.select("token", F.col("node").alias("b"), F.col("label").alias("b_label"), *[F.col(c).alias(f"b_{c}") for c in TOLD])


def _starred(rest: DataFrame, similarity: float) -> DataFrame:
    """(a, b) distinct: sets of a token that many share, each with some of those that hashes draw among them.

    The hashes are the nodes' own, so that tokens of the same sets draw the same ones. Their similar pairs connect most of a
    large group of near copies without the square of its size; what they don't connect meets later.
    """
    large = rest.groupBy("token").agg(F.count("*").alias("n"), *[F.min_by("node", F.xxhash64(F.lit(k), "node")).alias(f"s{k}") for k in range(STARS)]).where(F.col("n") > LARGE)
    stars = large.select("token", F.explode(F.array_distinct(F.array(*[f"s{k}" for k in range(STARS)]))).alias("b"))
    drawn = _others(rest).join(stars, ["token", "b"])
    met = rest.join(drawn, "token").where((F.col("label") != F.col("b_label")) & _possible("", "b_", similarity))
    often = met.groupBy("node", "size", "b", "b_size").agg(F.count("*").alias("n")).where(_enough(similarity)).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "b")), asc=False).alias("m"))
    tried = often.select("node", F.explode(F.slice("m", 1, MEETINGS)["b"]).alias("b"))
    return tried.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _by_similarity(docs: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The shingled rows, and (node, label) of the nodes that are linked.

    First come the links that fingerprints propose, then those of a few pairs in large groups; then all pairs of sets that
    share a shingle of their prefixes meet, but those that are connected already.
    """
    spark = docs.sparkSession
    rows = stored(shingled(docs, plan), "shingles")
    nodes = checkpointed(rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "p0", "p1", "p2", "p3", "fp")]))
    first = _similar(_proposed(nodes, plan), nodes, rows, plan.similarity)
    near = components(first).withColumnRenamed("a", "node")
    common = _common(rows)
    released(spark)
    prefixes, mark = _prefixes(rows, plan.similarity, *common), bookmark()
    held = stored(prefixes.groupBy("token").agg(F.min("node").alias("l"), F.max("node").alias("m")).where("l <> m").select("token"), "held")
    released(spark)
    shared = stored(prefixes.join(held, "token").select("token", "node").distinct(), "shared")
    released(spark)
    first = checkpointed(first.unionByName(_similar(_starred(_unconnected(shared, near, nodes), plan.similarity), nodes, rows, plan.similarity)))
    rest = _unconnected(shared, components(first).withColumnRenamed("a", "node"), nodes)
    fit = (F.col("node") < F.col("b")) & (F.col("label") != F.col("b_label")) & _possible("", "b_", plan.similarity)
    met = rest.join(_others(rest), "token").where(fit)
    pairs = met.groupBy("node", "size", "b", "b_size").agg(F.count("*").alias("n")).where(_enough(plan.similarity)).select(F.col("node").alias("a"), "b")
    found = first.unionByName(_similar(pairs, nodes, rows, plan.similarity))
    discard(spark, mark)
    released(spark)
    return rows, components(found).withColumnRenamed("a", "node")


def _labelled(docs: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, digest, node, label) by similarity: every row, with its set and the set's component."""
    mark = bookmark()
    rows, labels = _by_similarity(docs, plan)
    label = F.coalesce("label", "node").alias("label")
    named = checkpointed(rows.select("doc_id", "digest", "node").join(labels, "node", "left").select("doc_id", "digest", "node", label))
    discard(docs.sparkSession, mark)
    return named


def near_duplicates(docs: DataFrame, plan: Plan = CONTRACT) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, fp binary, component_id): every row, copies included; other columns are ignored.

    component_id is the least doc_id reachable over links, itself included; null where no document of the component has
    an id. Null and blank texts have fingerprint zero and link like any other. Repeated rows stay repeated. Under a plan
    with a similarity fp is a digest of the set of shingles.
    """
    if plan.similarity:
        rows = _labelled(docs, plan)
        least = checkpointed(rows.groupBy("label").agg(F.min("doc_id").alias("component_id")))
        return rows.join(least, "label").select("doc_id", F.unhex(F.lpad(F.hex("node"), 16, "0")).alias("fp"), "component_id")
    rows = checkpointed(fingerprints(docs, plan))
    nodes = checkpointed(
        rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id())
    )
    found = links(nodes, plan)
    named = nodes.select("fp", "node")
    by_node = (
        found.join(named.withColumnRenamed("fp", "a").withColumnRenamed("node", "na"), "a")
        .join(named.withColumnRenamed("fp", "b").withColumnRenamed("node", "nb"), "b")
        .select(F.col("na").alias("a"), F.col("nb").alias("b"))
    )
    labels = components(by_node)
    labelled = checkpointed(
        nodes.join(labels.withColumnRenamed("a", "node"), "node", "left").select("fp", "least", F.coalesce("label", "node").alias("label"))
    )
    least = checkpointed(labelled.groupBy("label").agg(F.min("least").alias("component_id")))  # of its own partitioning: a hot label can be split
    by_fp = labelled.join(least, "label").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, plan: Plan = NEAR_DEDUP) -> DataFrame:
    """The documents but one row of each group gone, with all columns; ``plan`` must have a similarity.

    The row of the least id stays; of rows that repeat it the least text digest, then the first in the order of the
    columns. A row without an id stays only where its group has no id. Only the keys of rows that go or repeat are joined
    to the documents, so that their texts aren't shuffled as long as those are few.
    """
    if not plan.similarity:
        raise ValueError("give a plan with a similarity")
    labelled = _labelled(docs, plan)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("m")
    stays = labelled.groupBy("label").agg(first).select("label", F.col("m.doc_id").alias("doc_id"), F.col("m.digest").alias("digest"), F.lit(True).alias("stays"))
    held = labelled.groupBy("label", "doc_id", "digest").agg(F.count("*").alias("n")).alias("h")
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("label", "doc_id", "digest")]
    own_id, own_digest, digest, again = (fresh(docs, n) for n in ("own_id", "own_digest", "digest", "again"))
    named = held.join(stays.alias("s"), same, "left").where(F.col("stays").isNull() | (F.col("n") > 1))
    told = checkpointed(named.select(F.col("h.doc_id").alias(own_id), F.col("h.digest").alias(own_digest), F.col("stays").isNotNull().alias(again)))
    repeats, few = told.where(f"`{again}`").count(), told.count() <= FEW // 2
    released(docs.sparkSession)
    rows = docs.withColumn(digest, _digest())
    of_row = rows["doc_id"].cast("long").eqNullSafe(F.col(own_id)) & (F.col(digest) == F.col(own_digest))
    marked = rows.join(F.broadcast(told) if few else told, of_row, "left")
    alone = marked.where(F.col(again).isNull()).select(*[F.col(f"`{n}`") for n in docs.columns])
    if not repeats:
        return alone
    plain = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    order = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(plain)])  # maps have no order of their own
    whole = F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(docs.columns)])
    one = marked.where(F.col(again)).groupBy("doc_id", digest).agg(F.min_by(whole, order).alias("m"))
    return alone.unionByName(one.select(*[F.col(f"m.c{i}").alias(n) for i, n in enumerate(docs.columns)]))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """All documents' fingerprints and components, as ``near_duplicates`` states it for nulls, empty texts and repeats; an empty
    table gives no rows."""
    from meridian.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents"), CONTRACT)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
