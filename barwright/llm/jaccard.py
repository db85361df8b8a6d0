"""Exact n-gram Jaccard join by universe partitioning (pigeonhole on segments).

A document is the set of its distinct word shingles.  Sets of one size band hash the universe
into m segments; two sets within the threshold differ in at most H elements (H from the sizes),
so when segment i of the probing set is granted v_i in {0, 1, 2} and the grants sum to H + 1,
some segment differs in fewer than v_i elements.  v = 1 looks for an equal segment subset,
v = 2 also for one that is one deletion away on either side, v = 0 for nothing.  Grants follow
cost: the expected list of a subset shrinks with its size, so empty and one-element segments
are dropped first, paid by the set's slack (its own H is below the band's) and then by granting
2 to the fullest of a few reserve segments, the only ones whose one-deletion neighbourhoods are
indexed.  If that does not pay for all, the remaining ones are probed as they are: exact always.

Equal sets form one class; only classes are linked.  Members of an equal signature are not
paired with each other: first each class is compared with one class, the lead of most of its
signatures; then each round compares them with a few leads of the signature (1, 4, 16, ...)
and goes on only where members of different components are left; what a long list holds beyond
its first lead is compared by the members' differences to that lead (``by_difference``).  So a
group of n near copies costs about n comparisons, yet no link between components is lost.  Pairs whose sizes or
parity sketches rule a link out are not made; what is left is verified on the whole shingle
sets (64-bit hashes of the words), which are read from the texts again for these pairs only
(``Sets``): a set has about twice the bytes of its text.  That gives components; ``links_of`` leaves
nothing out and gives every link and the number of links per class, at the price of all pairs
of a group.

Defined cases: null, empty or blank text has no shingles and is linked with nothing; a text of
fewer words than a shingle is one shingle; equal texts and repeated rows share a class; null
ids take part (a component's id is the smallest non-null id in it); an empty table gives an
empty result."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.llm.hashing import U64, mixed, shingle_hashes, word_hashes
from barwright.llm.text import if_small, partitions, written
from barwright.session import ensure_checkpoint_dir

#: bits of the candidate filter (2 MB); a fuller filter only lets more sets through
FILTER_BITS = 24
#: (partition, class) rows of 16 bytes that are broadcast to the sets at most
BROADCAST_KEYS = 1_000_000
#: 64-bit words of the sketch of fixed size that pairs are made by
BRIEF = 8
#: signatures whose further probes lie in more components than this are compared by differences to their lead
LONG = 64


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles."""
    return np.unique(shingle_hashes(word_hashes(text), k))


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit key of a set (order-independent sum of mixed elements, with its size)."""
    with np.errstate(over="ignore"):
        total = mixed(s + U64(len(s))).sum(dtype=U64)
    return int(mixed(np.array([total], U64))[0].astype(np.int64))


class Bands:
    """Size bands and their number of segments for a threshold of p/q."""

    def __init__(self, p: int, q: int, width: int = 3):
        self.p, self.q, self.width = p, q, width

    def bound(self, size: int) -> int:
        """Most differing elements of linked sets of which the larger has ``size``."""
        return 2 * size * (self.q - self.p) // (self.q + self.p)

    def band(self, size: int) -> tuple[int, int]:
        """First and last size of the band that holds ``size``."""
        first = 1
        while True:
            last = max(first, int(first * (self.q / self.p) ** self.width) - 1)
            if size <= last:
                return first, last
            first = last + 1

    def least(self, size: int) -> int:
        """Smallest size that can link with a larger set of ``size``."""
        return -(-size * self.p // self.q)


def signatures(s: np.ndarray, bands: Bands, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """(signature, probes) of a set: what it indexes and looks up in its own band, and what it
    indexes in the next band if a larger set there can link with it."""
    n = len(s)
    if n not in cache:
        first, last = bands.band(n)
        todo = [(first, last, True)]
        while bands.least(last + 1) <= n:
            first, last = bands.band(last + 1)
            todo.append((first, last, False))
        cache[n] = todo
    sigs, probes = [], []
    with np.errstate(over="ignore"):
        for first, last, own in cache[n]:
            m = bands.bound(last) + 1
            if m == 1:
                continue  # only equal sets link: they are one class
            salt = U64(first)
            e = mixed(s ^ mixed(np.array([salt * U64(0x51ED27)], U64)))
            seg = (e % U64(m)).astype(np.uint16 if m < 1 << 16 else np.int64)
            order = np.argsort(seg, kind="stable")
            e, sorted_seg = mixed(e[order] + U64(7)), seg[order]
            counts = np.bincount(seg, minlength=m)
            sums = np.zeros(m, U64)
            full = np.flatnonzero(counts)
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            sums[full] = np.add.reduceat(e, starts[full])
            ids = np.arange(m, dtype=np.int64).astype(U64) + (salt << U64(24))
            exact = mixed(sums + mixed(ids))
            grant = np.ones(m, np.int8)
            reserve = min(m, max(2, m // 50))
            if own:
                # the set's own bound leaves slack; the costliest (smallest) segments go first
                spare = m - 1 - bands.bound(n)
                dear = np.flatnonzero(counts <= 1)
                dear = dear[np.argsort(counts[dear], kind="stable")]
                free = dear[:spare]
                grant[free] = 0
                rich = [int(i) for i in np.argsort(-counts[:reserve], kind="stable") if counts[i] >= 3]
                for i, j in zip(dear[spare:], rich):
                    grant[i], grant[j] = 0, 2
            else:
                grant[:] = 0
            sigs.append(exact)
            probes.append(grant > 0)
            # one-deletion neighbourhoods of the reserve segments, in a signature space of their own
            cut = sorted_seg < reserve
            less = sums[sorted_seg[cut]] - e[cut]
            at = ids[sorted_seg[cut]]
            sigs.append(mixed(less + mixed(at + (U64(1) << U64(23)))))
            probes.append(np.zeros(cut.sum(), bool))
            if own:
                two = np.flatnonzero(grant == 2)
                if len(two):
                    sigs.append(mixed(sums[two] + mixed(ids[two] + (U64(1) << U64(23)))))
                    probes.append(np.ones(len(two), bool))
                    mine = np.isin(sorted_seg, two)
                    sigs.append(mixed(sums[sorted_seg[mine]] - e[mine] + mixed(ids[sorted_seg[mine]])))
                    probes.append(np.ones(mine.sum(), bool))
    if not sigs:
        return np.empty(0, U64), np.empty(0, bool)
    return np.concatenate(sigs), np.concatenate(probes)


def parities(s: np.ndarray, words: int) -> np.ndarray:
    """Parities of the elements per bin, as 64-bit words.  Each differing element flips one bin, so
    two sets differ in at least as many elements as their parities do in bins."""
    odd = np.bincount((s % U64(words * 64)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def sketch(s: np.ndarray, bands: Bands) -> np.ndarray:
    """Parities of a power of two of words, at least 8 bins for each element in which a linked set
    may differ."""
    words = 4
    while words * 64 < 8 * bands.bound(len(s)):
        words *= 2
    return parities(s, words)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """The sketch ``x`` as it is with fewer bins."""
    return np.bitwise_xor.reduce(x.reshape(-1, words), axis=0)


def text_hash(t: str | None) -> int:
    return xxhash.xxh64_intdigest((t or "").encode("utf-8", "surrogatepass")) - (1 << 63)


def keyed(docs: DataFrame, k: int, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """_id, the carried columns, _key (class; null without shingles), n_shingles, _text (hash of
    the text)."""
    src = docs.select(F.col(text_col).cast("string").alias("_t"), F.col(id_col).alias("_id"), *carry)
    schema = src.drop("_t").schema.add("_key", "long").add("n_shingles", "long").add("_text", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, size, text = [], [], []
            for at in range(0, b.num_rows, 500):
                for t in b.column(0).slice(at, 500).to_pylist():
                    s = shingles(t, k)
                    key.append(set_key(s) if len(s) else None)
                    size.append(len(s))
                    text.append(text_hash(t))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *(pa.array(x, pa.int64()) for x in (key, size, text))],
                                             ["_id", *carry, "_key", "n_shingles", "_text"])
    return src.mapInArrow(run, schema)


def signed(docs: DataFrame, k: int, bands: Bands, text_col: str) -> DataFrame:
    """(sig, key, probe) of every class, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = {}, set()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                sig, key, probe = [], [], []
                for t in b.column(0).slice(at, 500).to_pylist():
                    s = shingles(t, k)
                    if len(s) and (name := set_key(s)) not in seen:
                        seen.add(name)
                        x, p = signatures(s, bands, cache)
                        sig.append(x)
                        probe.append(p)
                        key.append(np.full(len(x), name, np.int64))
                if sig:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(sig).astype(np.int64)), pa.array(np.concatenate(key)),
                        pa.array(np.concatenate(probe))], ["sig", "key", "probe"])
    return docs.select(F.col(text_col).cast("string").alias("_t")).mapInArrow(run, "sig long, key long, probe boolean")


def shared(sigs: DataFrame) -> DataFrame:
    """Members (sig, key, probe) of the signatures that several classes hold.  Rows are sorted and
    streamed: a row goes out if a neighbour has its signature, so none is ever gathered."""
    placed = sigs.repartition(partitions(sigs.sparkSession), "sig").sortWithinPartitions(
        "sig", "key", F.col("probe").desc())
    names = ["sig", "key", "probe"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, met = None, False  # the last row so far, and whether its predecessor has its signature
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if last is not None:
                cols = [np.concatenate((x, y)) for x, y in zip(last, cols)]
            sig, key, _ = cols
            new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])))
            cols = [c[new] for c in cols]
            same = cols[0][1:] == cols[0][:-1]
            out = np.concatenate(([met], same))
            met = bool(out[-1])
            out[:-1] |= same
            last = [c[-1:] for c in cols]
            if out[:-1].any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out[:-1]]) for c in cols], names)
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], names)
    return placed.mapInArrow(run, "sig long, key long, probe boolean")


def hash_filter(hashes: DataFrame) -> bytes:
    """Bitmap of fixed size over the values of the one long column ``h``."""
    spot = F.pmod(F.col("h"), F.lit(1 << FILTER_BITS)) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(spot).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    out = bytearray((1 << FILTER_BITS) // 8)
    for r in rows.collect():  # at most 2**FILTER_BITS / 32768 rows of 4 KB
        at = (r["n"] - 1) * 4096
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def sets_of(docs: DataFrame, k: int, text_col: str, bits: bytes, made: Callable[[np.ndarray], list], schema: str) -> DataFrame:
    """(key, h, n, ..., src) of the texts that the filter lets through, once per task ``src`` and key: hash
    of the text, size of the set and the columns (arrays of longs, ``schema``) that ``made`` has of
    the set; a key that comes from several tasks has the same set in each."""
    held = docs.sparkSession.sparkContext.broadcast(bits)
    schema = f"key long, h long, n long, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held_keys, have = set(), set(), held.value
        names = [c.split()[0] for c in schema.split(", ")]
        for b in batches:
            for at in range(0, b.num_rows, 500):
                rows = []
                for t in b.column(0).slice(at, 500).to_pylist():
                    h = text_hash(t)
                    spot = h % (1 << FILTER_BITS)
                    if h not in seen and have[spot >> 3] >> (spot & 7) & 1 and len(s := shingles(t, k)):
                        seen.add(h)
                        if (name := set_key(s)) not in held_keys:
                            held_keys.add(name)
                            rows.append((name, h, len(s), *made(s)))
                if rows:
                    columns = [pa.array(list(c), pa.int64() if i < 3 else pa.list_(pa.int64())) for i, c in enumerate(zip(*rows))]
                    yield pa.RecordBatch.from_arrays(columns, names)
    return (docs.select(F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(run, schema).withColumn("src", F.spark_partition_id()))


def single(sets: DataFrame) -> DataFrame:
    """Rows of ``sets_of``, each key once: copies of a text lie in many tasks, and each of them would be
    sent wherever its set is needed.  Only the keys that occur twice are looked up; sets stay where
    they are as long as those keys are few enough to broadcast."""
    twice = written(sets.groupBy("key").agg(F.count("*").alias("n"), F.min("src").alias("keep")).where("n > 1")
                    .select("key", "keep"), "twice")
    return (sets.join(if_small(twice, twice.count(), BROADCAST_KEYS), "key", "left")
            .where("keep is null or keep = src").drop("keep", "src"))


class Sets:
    """The classes of an index: ``marks`` (key, h, n, sketch, brief) of all, their sets on demand.

    Most classes share a signature with another by chance and never meet a plausible partner, so
    their sets are not kept: ``of`` makes those asked for from one text of each class."""

    def __init__(self, docs: DataFrame, k: int, bands: Bands, text_col: str, texts: DataFrame):
        """``texts``: h, the hash of one text of each class."""
        self.docs, self.k, self.text_col = docs, k, text_col
        made = lambda s: [sketch(s, bands), parities(s, BRIEF)]
        found = sets_of(docs, k, text_col, hash_filter(texts), made, "sketch array<long>, brief array<long>")
        self.marks = written(single(written(found, "marks")), "marks")

    def of(self, keys: DataFrame) -> DataFrame:
        """(key, items) of the distinct ``keys``."""
        need = written(keys.join(self.marks.select("key", "h"), "key"), "needed")
        found = sets_of(self.docs, self.k, self.text_col, hash_filter(need.select("h")),
                        lambda s: [s.astype(np.int64)], "items array<long>")
        if need.count() <= BROADCAST_KEYS:  # else what the filter lets through beside them stays
            found = found.join(F.broadcast(need.select("key")), "key", "left_semi")
        return single(written(found.drop("h", "n"), "sets"))


def possible(x: tuple[str, str], y: tuple[str, str], p: int, q: int) -> Column:
    """Whether the sizes and parities of fixed size (names of ``n`` and ``brief``) leave room for a
    link.  As a condition of the join that makes pairs it keeps it from making the others."""
    (n, brief), (m, other) = x, y
    far = sum((F.bit_count(F.col(brief)[i].bitwiseXOR(F.col(other)[i])) for i in range(BRIEF)), F.lit(0))
    return (q * F.least(n, m) >= p * F.greatest(n, m)) & ((p + q) * far <= (q - p) * (F.col(n) + F.col(m)))


def plausible(pairs: DataFrame, marks: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches do not rule out; no link is lost.  A sketch has
    about a fortieth of its set's bytes, so pairs far from a link cost little."""
    marks = marks.select("key", "n", "sketch")
    met = (pairs.join(marks.withColumnsRenamed({"key": "a", "n": "na", "sketch": "sa"}), "a")
           .join(marks.withColumnsRenamed({"key": "b", "n": "nb", "sketch": "sb"}), "b")
           .where(q * F.least("na", "nb") >= p * F.greatest("na", "nb")).select("a", "b", F.expr("na + nb").alias("s"), "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, ends, flat = batch.column(2).to_numpy(), [], []
            for c in (batch.column(3), batch.column(4)):
                ends.append(c.offsets.to_numpy())
                flat.append(c.values.to_numpy())
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (f[e[i]:e[i + 1]] for e, f in zip(ends, flat))
                words = min(len(x), len(y))
                far = int(np.bitwise_count((folded(x, words) ^ folded(y, words)).view(np.uint64)).sum())
                keep[i] = far * (p + q) <= int(total[i]) * (q - p)
            if keep.any():
                yield batch.select([0, 1]).filter(pa.array(keep))
    return met.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: Sets, p: int, q: int) -> DataFrame:
    """The pairs (a, b) whose sets reach p/q.

    The sets of the b are dealt over partitions, and the set of an a goes once to each partition
    that holds any of its b (not once per pair), so a lead's set is sent to its list at most once
    per partition.  A task holds the sets of its partition."""
    n = partitions(pairs.sparkSession)
    pairs = written(plausible(pairs, sets.marks, p, q), "plausible")
    if pairs.isEmpty():
        return pairs
    ends = sets.of(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    place = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(n)).cast("int")
    none = lambda t: F.lit(None).cast(t)
    placed = pairs.select(place("b").alias("p"), "a", "b")
    need = written(placed.select("p", "a").union(placed.select("p", F.col("b").alias("a"))).distinct(), "need")
    need = if_small(need, need.count(), BROADCAST_KEYS)  # else the sets are shuffled too
    sent = need.join(ends.withColumnRenamed("key", "a"), "a").select("p", F.lit(0).alias("kind"), "a", none("long").alias("b"), "items")
    rows = sent.union(placed.select("p", F.lit(1), "a", "b", none("array<long>")))
    dealt = rows.repartitionById(n, F.col("p")).sortWithinPartitions("kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            items, keys, others = batch.column(4), batch.column(2).to_numpy(), batch.column(3).fill_null(0).to_numpy()
            pair = batch.column(1).to_numpy() == 1
            if not pair.all():
                ends, flat = items.offsets.to_numpy(), items.values.to_numpy()
                for i in np.flatnonzero(~pair).tolist():
                    held[int(keys[i])] = flat[ends[i]:ends[i + 1]]
            found = []
            for i in np.flatnonzero(pair).tolist():
                x, y = held[int(keys[i])], held[int(others[i])]
                if q * min(len(x), len(y)) >= p * max(len(x), len(y)):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if q * same >= p * (len(x) + len(y) - same):
                        found.append(i)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(keys[found]), pa.array(others[found])], ["a", "b"])
    return dealt.mapInArrow(run, "a long, b long")


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the driver collects
    its garbage, which a driver with room to spare puts off while the disks fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(links: DataFrame) -> DataFrame:
    """(key, comp) of linked classes, comp the smallest class reachable: labels hook onto the
    smallest adjacent label, chains of hooks are jumped, until no link joins two labels.  Joins
    and aggregations over linked classes only."""
    # tables between iterations are written: a checkpoint would hand on the plan's constraints,
    # which multiply from iteration to iteration
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    comp = written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "key"), "labels")
    while True:
        hook = written(edges.join(comp.withColumnsRenamed({"key": "a", "comp": "label"}), "a")
                       .join(comp.withColumnsRenamed({"key": "b", "comp": "other"}), "b")
                       .where(F.col("other") < F.col("label")).groupBy("label").agg(F.min("other").alias("to")), "hooks")
        if hook.isEmpty():
            return comp
        while True:
            far = hook.select(F.col("label").alias("to"), F.col("to").alias("far"))
            jumped = written(hook.join(far, "to", "left"), "jumps")
            hook = jumped.select("label", F.coalesce("far", "to").alias("to"))
            if jumped.where("far is not null").isEmpty():
                break
        comp = written(comp.join(hook, comp["comp"] == hook["label"], "left")
                       .select("key", F.coalesce("to", "comp").alias("comp")), "labels")


def merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """``comp`` (key, comp) after further links: the links are carried over to components, and
    only components that they join get new labels."""
    if comp is None:
        return components(links)
    label = lambda c: comp.withColumnsRenamed({"key": c, "comp": f"c{c}"})
    over = written(links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "joined")
    new = components(over).withColumnsRenamed({"key": "old", "comp": "new"})
    moved = comp.join(new, F.col("comp") == F.col("old"), "left").select("key", F.coalesce("new", "comp").alias("comp"))
    fresh = new.join(comp, F.col("old") == F.col("key"), "left_anti").select(F.col("old").alias("key"), F.col("new").alias("comp"))
    return written(moved.union(fresh), "labels")


def by_difference(dense: DataFrame, sets: Sets, p: int, q: int) -> DataFrame:
    """Candidate pairs (a, b) among the members of long signature lists, by their differences to
    the list's lead; ``dense``: (lead, key, comp).

    With D(x) the symmetric difference of x to the lead, two members differ in |D(x)| + |D(y)| -
    2 |D(x) & D(y)| elements.  If x is not linked to the lead (members that are share its
    component), a link of x and y needs a common element of D(x) and D(y), and at least
    (G(x) + G(y)) / 2 of them, G(x) = |D(x)| - |x| (q - p) / (q + p).  So differences are joined by
    their rarest elements only (prefix filter), and near copies that are no links are not paired."""
    some = sets.of(dense.select(F.col("lead").alias("key")).union(dense.select("key")).distinct())
    d = (dense.join(some.withColumnsRenamed({"key": "lead", "items": "x"}), "lead")
         .join(some.withColumnRenamed("items", "y"), "key")
         .select("lead", "key", "comp", F.size("x").alias("lead_size"), F.size("y").alias("size"),
                 F.array_union(F.array_except("x", "y"), F.array_except("y", "x")).alias("diff"))
         .withColumn("n", F.size("diff")))
    d = written(d.withColumn("g", (q + p) * F.col("n") - (q - p) * F.col("size"))
                .withColumn("linked", (q + p) * F.col("n") <= (q - p) * (F.col("size") + F.col("lead_size"))), "differences")
    low = d.where(~F.col("linked")).groupBy("lead").agg(F.min("g").alias("low"))
    least = F.greatest(F.lit(1), F.ceil((F.col("g") + F.col("low")) / (2.0 * (p + q))))
    e = d.join(low, "lead").select("lead", "key", "comp", "linked", (F.col("n") - least + 1).alias("prefix"),
                                   F.explode("diff").alias("e"))
    e = e.join(e.groupBy("lead", "e").agg(F.count("*").alias("f")), ["lead", "e"])
    rank = F.row_number().over(Window.partitionBy("lead", "key").orderBy("f", "e"))
    e = written(e.withColumn("first", rank <= F.col("prefix")).where("f > 1").select("lead", "e", "key", "comp", "linked", "first"),
                "elements")
    mine = e.where(~F.col("linked")).withColumnsRenamed({"key": "a", "comp": "ca"}).drop("linked")
    other = e.where("first").withColumnsRenamed({"key": "b", "comp": "cb", "linked": "known"}).drop("first")
    # two unlinked members meet in both prefixes, an unlinked and a linked one in the latter's
    pairs = mine.join(other, ["lead", "e"]).where(
        (F.col("ca") != F.col("cb")) & (F.col("known") | (F.col("first") & (F.col("a") < F.col("b")))))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def indexed(docs: DataFrame, ids: DataFrame, k: int, percent: int, text_col: str) -> tuple[DataFrame, Sets]:
    """(sig, key, probe) of the signatures that several classes hold, and those classes; ``ids``:
    the keyed documents."""
    bands = Bands(percent, 100)
    rows = written(shared(signed(docs, k, bands, text_col)), "signatures")
    released(docs.sparkSession)
    texts = (ids.groupBy("_key").agg(F.min("_text").alias("h"))
             .join(rows.select(F.col("key").alias("_key")).distinct(), "_key", "left_semi").select("h"))
    return rows, Sets(docs, k, bands, text_col, texts)


def links_of(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The join itself: every pair of classes that meets in a signature is verified, whether or
    not its members already share a component.

    Links, one row per pair of linked classes: a < b (class keys), id_a, id_b (smallest ids).
    Counts, one row per class: class_key, id, n_docs (its documents), n_links (linked classes),
    n_linked_docs (their documents).  Documents of one class have equal sets and are not paired:
    a document's links are n_linked_docs and the n_docs - 1 others of its class."""
    ensure_checkpoint_dir(docs.sparkSession)
    ids = written(keyed(docs, k, id_col, text_col, []), "classes")
    rows, sets = indexed(docs, ids, k, percent, text_col)
    rows = rows.join(sets.marks.select("key", "n", "brief"), "key")
    one, two = (rows.withColumnsRenamed({"key": x, "probe": f"p{x}", "n": f"n{x}", "brief": f"s{x}"}) for x in "ab")
    pairs = written(one.join(two, "sig").where((F.col("a") < F.col("b")) & (F.col("pa") | F.col("pb"))
                                               & possible(("na", "sa"), ("nb", "sb"), percent, 100))
                    .select("a", "b").distinct(), "pairs")
    links = written(verified(pairs, sets, percent, 100), "links")
    held = written(ids.where(F.col("_key").isNotNull()).groupBy(F.col("_key").alias("class_key")).agg(
        F.min("_id").alias("id"), F.count("*").alias("n_docs")), "held")
    ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    per_class = (ends.join(held.select(F.col("class_key").alias("b"), "n_docs"), "b").groupBy(F.col("a").alias("class_key"))
                 .agg(F.count("*").alias("n_links"), F.sum("n_docs").alias("n_linked_docs")))
    counts = held.join(per_class, "class_key", "left").na.fill(0, ["n_links", "n_linked_docs"])
    name = lambda c: held.select(F.col("class_key").alias(c), F.col("id").alias(f"id_{c}"))
    return links.join(name("a"), "a").join(name("b"), "b").select("a", "b", "id_a", "id_b"), counts


def class_components(docs: DataFrame, ids: DataFrame, k: int, percent: int, text_col: str = "text") -> DataFrame:
    """(key, comp) of the classes that have links; ``ids``: the keyed documents."""
    p, q = percent, 100
    rows, sets = indexed(docs, ids, k, percent, text_col)
    brief = sets.marks.select("key", "n", "brief")
    by = Window.partitionBy("sig")
    # ranks with probes first: pairs of two that only index need no comparison
    # ... and then members of many and long lists: the least edited copies lead all lists they are in
    rows = rows.withColumn("_n", F.count("*").over(by))
    weight = rows.groupBy("key").agg(F.sum("_n").alias("weight"))
    rows = rows.drop("_n").join(weight, "key").withColumn(
        "rank", F.row_number().over(by.orderBy(F.col("probe").desc(), F.col("weight").desc(), "key"))).drop("weight")
    # first each class meets one lead, that of most of its lists: near copies then share a component,
    # and the rounds below compare what is left
    rows = written(rows, "ranked")
    lead_of = rows.where("rank = 1 AND probe").select("sig", F.col("key").alias("lead"))
    met = rows.where("rank > 1").join(lead_of, "sig").groupBy("key", "lead").agg(F.count("*").alias("n"))
    first = met.groupBy("key").agg(F.max_by("lead", F.struct("n", "lead")).alias("lead"))
    first = written(first.select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct(), "pairs")
    found = written(verified(first, sets, p, q), "links")
    comp, done, lead = None if found.isEmpty() else merged(None, found), 0, 1
    released(docs.sparkSession)
    while True:
        held = rows.withColumn("comp", F.col("key")) if comp is None else (
            rows.join(comp, "key", "left").withColumn("comp", F.coalesce("comp", "key")))
        # go on where a probe is left and members of different components are
        held = (held.where(F.col("rank") > done).withColumn("lo", F.min("comp").over(by))
                .withColumn("hi", F.max("comp").over(by)).withColumn("any", F.max("probe").over(by))
                .where((F.col("lo") != F.col("hi")) & F.col("any")).drop("lo", "hi", "any"))
        held = written(held, "members")
        if held.isEmpty():
            break
        heads = held.where((F.col("rank") <= done + lead) & F.col("probe")).select(
            "sig", F.col("key").alias("lead"), F.col("rank").alias("first"), F.col("comp").alias("lead_comp"))
        far = heads.join(brief.withColumnsRenamed({"key": "lead", "n": "lead_n", "brief": "lead_brief"}), "lead")
        pairs = (held.join(brief, "key").join(far, "sig")
                 .where((F.col("rank") > F.col("first")) & (F.col("comp") != F.col("lead_comp"))
                        & possible(("n", "brief"), ("lead_n", "lead_brief"), p, q))
                 .select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct())
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            found = written(verified(pairs, sets, p, q), "links")
            if not found.isEmpty():
                comp = merged(comp, found)
        done, lead = done + lead, 4 * lead
        rows = held.drop("comp")
        released(docs.sparkSession)
        if done == 1:
            # what is left of long lists is compared by differences to their leads
            lists = rows.where("rank > 1")
            lists = lists.withColumn("comp", F.col("key")) if comp is None else lists.join(comp, "key", "left").withColumn(
                "comp", F.coalesce("comp", "key"))
            # leads are probes: lists with few of them end within a few rounds
            wide = (lists.where("probe").select("sig", "comp").distinct().groupBy("sig").agg(F.count("*").alias("n"))
                    .where(F.col("n") > LONG).select("sig"))
            wide = written(wide, "wide")
            if not wide.isEmpty():
                dense = (lists.join(wide, "sig").join(heads.select("sig", "lead"), "sig")
                         .select("lead", "key", "comp").distinct())
                pairs = written(by_difference(dense, sets, p, q), "pairs")
                found = written(verified(pairs, sets, p, q), "links")
                if not found.isEmpty():
                    comp = merged(comp, found)
                rows = written(rows.join(wide, "sig", "left_anti"), "members")
                released(docs.sparkSession)
    return comp if comp is not None else docs.sparkSession.createDataFrame([], "key long, comp long")


def components_of(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, carried columns, n_shingles, component_id (smallest id reachable, itself
    included), class_key and component_key (equal sets; linked classes; null without shingles)."""
    ensure_checkpoint_dir(docs.sparkSession)
    ids = written(keyed(docs, k, id_col, text_col, list(carry)), "classes")
    comp = class_components(docs, ids, k, percent, text_col)
    lows = (ids.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_id").alias("low"))
            .join(comp.withColumnRenamed("key", "_key"), "_key", "left")
            .withColumn("comp", F.coalesce("comp", "_key")))
    lows = written(lows, "lows")
    best = lows.groupBy("comp").agg(F.min("low").alias("component_id"))
    per_class = lows.select("_key", "comp").join(best, "comp")
    linked = ids.where(F.col("_key").isNotNull()).join(per_class, "_key")
    alone = ids.where(F.col("_key").isNull()).withColumn("component_id", F.col("_id")).withColumn(
        "comp", F.lit(None).cast("long"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_col), *carry, "n_shingles", "component_id",
        F.col("_key").alias("class_key"), F.col("comp").alias("component_key"))
