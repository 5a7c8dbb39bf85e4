"""N-gram Jaccard join by parity sketches.

Every document becomes a set of word n-gram hashes. The hash space is cut into blocks, and a block's word holds the parity (XOR) of one-hot
bits of the n-grams that fall into it, so two sketches differ in at most as many bits as the sets differ in elements. Sets of similarity
``s`` or more differ in at most (1-s)/(1+s) * (|A|+|B|) elements; with one block more than that bound of the size band, at least one block of the
sketch must be equal (pigeonhole). A few blocks more make up for words of fewer than two bits, which tell nothing and are left out. The steps:

1. one pass over the texts gives set size, set digest, a compact sketch, and the block keys of the size bands of every document;
2. equal sets count once; a block that few documents share ties its pairs, if their compact sketches pass the Hamming bound; a block that many share
   ties each of them to its smallest document. No step makes pairs of a large group's members;
3. the ties' connected components are families. The members of a family meet in tiles of bounded size, where sketches are compared as bit vectors and
   pairs inside the Hamming bound are verified on the sets; a tile gives only links that join parts which no earlier link has joined;
4. connected components of the verified links and of equal sets.

A link is never lost: linked documents share a block, hence are tied or in one family, hence in one tile.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import U, mix, segment_sums, shingle_sets
from .tables import components, keep, likely_among, plain

GROWTH = 1.5        # width of a size band
FEW = 16            # up to so many documents of a block are tied pair by pair
SPARE = 0.02        # blocks added to the bound, as a share of it; and one more
TILE_ROWS = 1024    # documents of one side of a tile; a member's text is sent to each chunk it meets, so larger chunks move less
TILE_GRAMS = 1 << 20  # n-grams of one side of a tile, about
GRAMS_A_BLOCK = 9   # n-grams of a block, at most on average, when only a number of blocks is taken
EXACT_GRAMS = 63    # bands of sets of fewer n-grams than this are searched exactly even then


def bands(top: int = 1 << 40) -> np.ndarray:
    """Lower bounds of the size bands."""
    low, out = 1, [1]
    while low < top:
        low = max(low + 1, int(low * GROWTH))
        out.append(low)
    return np.array(out, np.int64)


def most_apart(total, numerator: int, denominator: int):
    """Largest symmetric difference of linked sets whose sizes sum to ``total``: 100*i >= 90*u gives d <= total*(100-90)/(100+90)."""
    return total * (denominator - numerator) // (denominator + numerator)


def ends(counts: np.ndarray) -> np.ndarray:
    """Offsets of segments with the given lengths."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def slots(values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block, of ``blocks`` equal ranges of the hash space, that each value falls into."""
    return (((values >> U(32)) * blocks.astype(U)) >> U(32)).astype(np.int64)


def parity(values: np.ndarray, offsets: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity words of each segment of sorted hashes, ``blocks`` words for each, one after the other; with the words' offsets."""
    base = ends(blocks)
    out = np.zeros(base[-1], U)
    if len(values):
        count = np.diff(offsets)
        slot = slots(values, np.repeat(blocks, count)) + np.repeat(base[:-1], count)
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        out[slot[first]] = np.bitwise_xor.reduceat(U(1) << (values & U(63)), first)
    return out, base


def exact_blocks(values, offsets, use, band, numerator, denominator):
    """Blocks of the pigeonhole bound: (set, key) of all words that have to be compared."""
    bound = most_apart(2 * (bands()[band + 1] - 1), numerator, denominator)
    spare = np.where(bound > 0, (bound * SPARE).astype(np.int64) + 1, 0)
    blocks = np.where(use, bound + 1 + spare, 0)
    n = np.diff(offsets)
    word, base = parity(values[np.repeat(use, n)], ends(np.where(use, n, 0)), blocks)
    owner = np.repeat(np.arange(len(n)), blocks)
    key = mix(word ^ mix((np.arange(len(word)) - base[owner]).astype(U) + (band[owner].astype(U) << U(40))))
    thin = np.bitwise_count(word) < 2
    # linked sketches agree in 1 + spare words or more, so a set with no more thin words than spare ones can do without them
    keep_word = ~(thin & (np.bincount(owner[thin], minlength=len(n)) <= spare)[owner])
    return owner[keep_word], key[keep_word]


def small_blocks(values, offsets, use, band, numerator, denominator):
    """Like exact_blocks and as exact, for small sets, whose words are thin: half as many blocks again, so that few sets need their thin words."""
    top = bands()[band + 1] - 1
    n = np.diff(offsets)
    bound = most_apart(2 * top, numerator, denominator)
    blocks = np.where(use, bound + bound // 2 + 3, 0)
    word, base = parity(values[np.repeat(use, n)], ends(np.where(use, n, 0)), blocks)
    owner = np.repeat(np.arange(len(n)), blocks)
    key = mix(word ^ mix((np.arange(len(word)) - base[owner]).astype(U) + (band[owner].astype(U) << U(40))))
    bits = np.bitwise_count(word)
    apart = most_apart(n + np.minimum(top, n * denominator // max(numerator, 1)), numerator, denominator)
    # a linked sketch differs in at most ``apart`` words, so with more words of so many bits one of these agrees, and the others are not needed
    least = np.where(np.bincount(owner[bits > 0], minlength=len(n)) > apart, 1, 0)
    least = np.where(np.bincount(owner[bits > 1], minlength=len(n)) > apart, 2, least)
    good = bits >= least[owner]
    return owner[good], key[good]


def some_blocks(values, offsets, use, band, number):
    """``number`` blocks of at most about GRAMS_A_BLOCK n-grams each, from as many hash orders as that takes: (set, key)."""
    per_order = -(-(bands()[band + 1] - 1) // GRAMS_A_BLOCK)
    taken = np.minimum(per_order, number)
    orders = np.where(use, -(-number // taken), 0)
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    sets, keys = [], []
    for order in range(int(orders.max(initial=0))):
        active = (orders > order)[owner]
        mine = owner[active]
        h = mix(values[active] ^ U(0x9E37 * order + 0x79B9)) if order else values[active]
        slot = slots(h, per_order[mine])
        inside = slot < taken[mine]
        base = ends(np.where(orders > order, taken, 0))
        word = np.zeros(base[-1], U)
        np.bitwise_xor.at(word, base[mine[inside]] + slot[inside], U(1) << (h[inside] & U(63)))
        of = np.repeat(np.arange(len(n)), np.diff(base))
        good = np.bitwise_count(word) >= 3
        key = mix(word ^ mix((np.arange(len(word)) - base[of]).astype(U) + (band[of].astype(U) << U(40)) + U(order << 32)))
        sets.append(of[good])
        keys.append(key[good])
    return np.concatenate([*sets, np.zeros(0, np.int64)]), np.concatenate([*keys, np.zeros(0, U)])


def block_keys(values: np.ndarray, offsets: np.ndarray, numerator: int, denominator: int, blocks: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each set in its own band and in all bands where a larger partner may be; with offsets."""
    low, n = bands(), np.diff(offsets)
    own = np.searchsorted(low, np.maximum(n, 1), side="right") - 1
    found = []
    for up in count():
        use = (n > 0) & ((up == 0) | (n * denominator >= low[own + up] * numerator))
        if up and not use.any():
            break
        if blocks:
            small = low[own + up + 1] <= EXACT_GRAMS
            found.append(small_blocks(values, offsets, use & small, own + up, numerator, denominator))
            found.append(some_blocks(values, offsets, use & ~small, own + up, blocks))
        else:
            found.append(exact_blocks(values, offsets, use, own + up, numerator, denominator))
    owner, key = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(owner, kind="stable")
    return key[order], ends(np.bincount(owner, minlength=len(n)))


def sketch_words(n: np.ndarray) -> np.ndarray:
    """Words of the compact sketch: the power of two that gives 2 bits or more for each element."""
    return 1 << np.ceil(np.log2(np.maximum(n, 32) / 32)).astype(np.int64)


def sketches(texts: DataFrame, k: int, numerator: int, denominator: int, blocks: int | None) -> DataFrame:
    """(id, n, h1, h2, bits, keys) of every document of (id, text)."""
    def run(batches):
        for batch in batches:
            for a, b, values, off in shingle_sets(batch.column(1), k):
                keys, at = block_keys(values, off, numerator, denominator, blocks)
                word, base = parity(values, off, sketch_words(np.diff(off)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.diff(off), pa.int64()),
                    pa.array(segment_sums(mix(values + U(0x51ED27)), off).view(np.int64)), pa.array(segment_sums(mix(values ^ U(0xA5A5A5A5A5A5)), off).view(np.int64)),
                    pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(base) - 1, [None, pa.py_buffer(base * 8), pa.py_buffer(word)]).cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys.view(np.int64)))], names=["id", "n", "h1", "h2", "bits", "keys"])
    return texts.mapInArrow(run, "id long, n long, h1 long, h2 long, bits binary, keys array<long>")


def _inside_bound(numerator: int, denominator: int):
    """Keeps the pairs (a, b, na, nb, bits_a, bits_b) whose compact sketches can belong to linked sets."""
    def run(batches):
        for batch in batches:
            left, right = (np.array(batch.column(c)) for c in (2, 3))
            good = np.minimum(left, right) * denominator >= np.maximum(left, right) * numerator
            bound = most_apart(left + right, numerator, denominator)
            for i in np.flatnonzero(good):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), U) for c in (4, 5))
                if len(x) > len(y):
                    x = np.bitwise_xor.reduce(x.reshape(len(y), -1), axis=1)
                elif len(y) > len(x):
                    y = np.bitwise_xor.reduce(y.reshape(len(x), -1), axis=1)
                good[i] = np.bitwise_count(x ^ y).sum() <= bound[i]
            yield batch.select(["a", "b"]).filter(pa.array(good))
    return run


def _link(ids, sets, left, right, numerator: int, denominator: int):
    """Links between ``left`` and ``right`` members that join what is not joined yet: a forest of verified pairs."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    size = np.array([len(s) for s in sets], np.int64)
    words = int(size.max()) // 16 + 1
    bits = parity(np.concatenate(sets), ends(size), np.full(len(sets), words))[0].reshape(len(sets), words)
    alike, right = left is right, np.array(right)
    out = []
    for i in left:
        others = right[right > i] if alike else right
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[(low > 0) & (low * denominator >= high * numerator)]
        if not len(others):
            continue
        apart = np.zeros(len(others), np.int64)
        for c in range(0, words, 64):
            apart += np.bitwise_count(bits[others, c:c + 64] ^ bits[i, c:c + 64]).sum(axis=1, dtype=np.int64)
        near = apart <= most_apart(size[others] + size[i], numerator, denominator)
        for j in others[near][np.argsort(apart[near], kind="stable")].tolist():
            if find(i) == find(j):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both * denominator >= numerator * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
                out.append((ids[i], ids[j]))
    return out


def _tile(k: int, numerator: int, denominator: int):
    def run(table: pa.Table) -> pa.Table:
        ids, side = table.column("id").to_pylist(), table.column("side").to_pylist()
        sets = [None] * len(ids)
        for a, b, values, off in shingle_sets(table.column("text"), k):
            for r in range(a, b):
                sets[r] = values[off[r - a]:off[r - a + 1]]
        left, right = [r for r, s in enumerate(side) if s == 0], [r for r, s in enumerate(side) if s == 1]
        one = table.column("tile")[0].as_py().split("-")
        if one[:2] == one[2:]:  # a chunk with itself
            right = left
        pairs = _link(ids, sets, left, right, numerator, denominator) if left and right else []
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})
    return run


def _tiles(members: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(id, family, tile, side): the tiles in which each member (id, n, family) meets the others.

    A family of one tile's extent is one tile. A larger one is cut into bands of set sizes, so narrow that linked sets lie in the same or in neighbouring bands, and bands
    into chunks; chunks of the same or of neighbouring bands meet.
    """
    def chunks(many, grams):
        return F.ceil(F.greatest(F.col(many) / TILE_ROWS, F.col(grams) / TILE_GRAMS)).cast("int")

    width = math.log(denominator / numerator) * 1.001 if numerator else 1e9
    banded = members.withColumn("band", F.floor(F.log("n") / width).cast("int"))
    parts = banded.groupBy("family", "band").agg(F.count("*").alias("many"), F.sum("n").alias("grams"))
    whole = parts.groupBy("family").agg(F.sum("many").alias("all_many"), F.sum("grams").alias("all_grams")).filter("all_many > 1").select("family", (chunks("all_many", "all_grams") == 1).alias("one"))
    parts = keep(parts.join(whole, "family").select("family", "one", F.when(F.col("one"), 0).otherwise(F.col("band")).alias("band"), F.when(F.col("one"), 1).otherwise(chunks("many", "grams")).alias("chunks")).distinct(), "bands")
    sizes = parts.groupBy("family", "one").agg(F.map_from_entries(F.collect_list(F.struct("band", "chunks"))).alias("chunks"))
    placed = banded.join(sizes, "family").withColumn("band", F.when(F.col("one"), 0).otherwise(F.col("band")))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")[F.col("band")]).cast("int"))

    def meeting(band, other, side):
        """Tiles with the chunks of one band; the tile's name is the same for both sides."""
        n = F.coalesce(F.col("chunks")[other], F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda j: F.struct(band(j).alias("tile"), side(j).alias("side")))

    name = lambda b, i, c, j: F.concat_ws("-", b, i, c, j)
    own, band = F.col("own"), F.col("band")
    same = meeting(lambda j: name(band, F.least(own, j), band, F.greatest(own, j)), band, lambda j: F.when(own <= j, 0).otherwise(1))
    above = meeting(lambda j: name(band, own, band + 1, j), band + 1, lambda j: F.lit(0))
    below = meeting(lambda j: name(band - 1, j, band, own), band - 1, lambda j: F.lit(1))
    return placed.select("id", "family", F.explode(F.concat(same, above, below)).alias("t")).select("id", "family", "t.tile", "t.side")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: tuple[int, int] = (8, 10), blocks: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of documents linked by ``numerator/denominator`` or more word n-gram Jaccard similarity.

    Words are [^\\x20\\x09-\\x0D]+ after A-Z became lower case. Fewer than k words make one shingle; no words or null text an empty set, linked with
    nothing. component_id is the smallest id reachable by links. Ids are integers; rows with a null id stand alone. Repeated ids
    are one node: their sets are each compared, and every row gets the node's component. Other columns are ignored; an empty table gives no rows.

    Without ``blocks`` the search is exact. Low similarities make the exact scheme costly (a block then holds few n-grams and there are many). With ``blocks`` the
    search is exact for pairs whose larger set has fewer than EXACT_GRAMS n-grams; other sets take so many blocks of at most GRAMS_A_BLOCK n-grams from
    independent hash orders, and a pair of similarity s is missed with a probability of at most about
    (1 - exp(-2 * GRAMS_A_BLOCK * (1-s)/(1+s))) ** blocks: 0.0001 for s = 0.8 and 64 blocks, less than 1e-13 for s = 0.9.
    """
    numerator, denominator = similarity
    texts = plain(docs, id=F.col(f"`{id_col}`").cast("long"), text=text_col)
    marks = keep(sketches(texts, k, numerator, denominator, blocks), "sketches")
    named = marks.filter("id IS NOT NULL AND n > 0").select("id", "n", "h1", "h2")
    heads = named.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep"))
    copies = keep(named.join(heads, ["n", "h1", "h2"]).select("id", "rep", "n").distinct(), "copies")
    lone = copies.filter("id = rep").groupBy("id").agg(F.max("n").alias("n"))
    # block members; of equal sets only one, whose keys alone are moved, and once: counting them and finding the shared ones read the same exchange
    maybe, firsts = likely_among(marks.filter("id IS NOT NULL").select("id", "keys"), "id", copies.filter("id <> rep").select("id"))
    firsts = firsts.unionByName(maybe.join(lone.select("id"), "id", "left_semi"))  # only lists of keys that may be a copy's are moved for this
    keyed = firsts.select("id", F.explode("keys").alias("key"))
    blocked = keyed.repartition("key").groupBy("key", "id").agg(F.count("*").alias("rows"))
    sizes = blocked.groupBy("key").agg(F.count("*").alias("many"), F.min("id").alias("head")).filter("many > 1")
    ranked = keep(blocked.join(sizes, "key").select("key", "id", "many", "head"), "blocked")
    heavy = ranked.filter((F.col("many") > FEW) & (F.col("id") > F.col("head"))).select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    groups = ranked.filter(F.col("many") <= FEW).groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("ids").distinct()
    pairs = groups.select(F.explode(F.flatten(F.transform("ids", lambda x, i: F.transform(F.filter("ids", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b").distinct()
    bits = marks.filter("id IS NOT NULL")
    near = pairs.join(bits.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a")), "a").join(bits.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b")), "b")
    near = near.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(_inside_bound(numerator, denominator), "a long, b long")
    family = components(near.unionByName(heavy))  # (node, label)
    members = keep(family.join(lone, family["node"] == lone["id"]).select("id", "n", F.col("label").alias("family")), "members")
    tiles = _tiles(members, numerator, denominator)
    rows = likely_among(texts, "id", members.select("id"))[0].join(tiles, "id").select("family", "tile", "side", "id", "text")
    links = rows.groupBy("family", "tile").applyInArrow(_tile(k, numerator, denominator), "a long, b long")
    joined = components(links.unionByName(copies.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    return marks.select("id", "n").join(joined, marks["id"] == joined["node"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id"))
