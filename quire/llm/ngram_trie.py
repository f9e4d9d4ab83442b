"""N-gram Jaccard join by a prefix tree.

A document's set holds the hashes of its different word n-grams, in one global
order (ascending hash). Two documents link when the Jaccard similarity of their
sets reaches a whole percentage.

Distribution. Documents with equal sets are one class. The sizes of linked sets bound how
many elements only one of them has; a set is dealt by element hash into more parts than that,
so linked sets hold equal parts. Every class announces the digests of its parts with the
most elements, one more than the bound: of the equal parts the first in that order is
announced by both sides. So linked classes announce a part in common, and it is one of
several elements that unlinked classes seldom share whole: a common line or passage
groups nobody. The number of parts follows from a band of sizes; a set whose partners may
be in the next band announces itself there too. What a part's classes have in common is one
combinable minimum, however many they are; classes of one minimum form candidate groups
(connected components of stars, never pairs), and only their sets travel.

Join. The sets of a group, in blocks of bounded size, go into a path-compressed
trie. A set is joined with the whole trie in one traversal: sets with a common
beginning share its partial overlap, and a subtree is left as soon as the overlap
so far and the lengths that remain cannot reach the threshold, or when everything
below already belongs to the set's component. Groups of several blocks share a few
of their sets as bridges; where that leaves a group in several components, the classes
that share a part across components meet once more, by that part. No link between
components is lost, and there is no limit on partners.

Words are runs without ASCII white space of the text with A-Z lower-cased. With
fewer words than ``n`` the whole sequence is the one n-gram. Defined results: no
words or null text is the empty set, which links with nothing; repeated rows are
rows of one class; a row's component is the smallest id reachable, its own included
(null only if all are null); the join reads no other columns, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bitmap_of, components, free_name, frees_memory, ship_package, shuffle_parts, slices, stage, unstage
from quire.llm.syncmers import mix

_A = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)     # the first bytes of eight
_LONG = 64                                                           # bytes of a word taken eight at a time


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of the words of ``data``, which begins with one and ends with eight spaces."""
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | (raw - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw) - 7, "<u8", data, strides=(1,))      # the eight bytes from every place on
    h = mix((size.astype(np.uint64) * _A[0] + (eight[start] & _LOW[np.minimum(size, 8)])) * _A[1])
    rest, done = np.flatnonzero(size > 8), 8
    while len(rest) and done < _LONG:
        h[rest] = mix((h[rest] + (eight[start[rest] + done] & _LOW[np.minimum(size[rest] - done, 8)])) * _A[1])
        done += 8
        rest = rest[size[rest] > done]
    for i in rest.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i]:start[i] + size[i]], digest_size=8).digest(), "little")
    return start, h


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    x = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        x = mix((x + h[j:len(x) + j]) * _A[j % 3])
    return x


def ngram_sets(texts: Iterable[str | None], n: int = 3, chars: int = 1 << 18):
    """Of every text in turn, the ascending different hashes of its word n-grams. Texts are
    taken together up to ``chars`` characters, so that words are found and hashed many at a time."""
    some, held = [], 0
    for text in texts:
        if some and held + len(text or "") > chars:
            yield from _sets_of(some, n)
            some, held = [], 0
        some.append(text or "")
        held += len(text or "")
    if some:
        yield from _sets_of(some, n)


def _sets_of(texts: list[str], n: int):
    raw = [text.encode() for text in texts]
    start, h = word_hashes(b" " + b" ".join(raw).lower() + b" " * 8)     # bytes: ASCII case and white space only
    x = _grams(h, n) if len(h) >= n else h[:0]                           # those across two texts are not read
    lo = 0
    for hi in np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw])).tolist():
        own = x[lo:hi - n + 1] if hi - lo >= n else _grams(h[lo:hi], hi - lo) if hi > lo else h[:0]
        own = np.sort(own)
        yield own[np.concatenate([own[:1] == own[:1], own[1:] != own[:-1]])]
        lo = hi


def ngram_set(text: str | None, n: int = 3) -> np.ndarray:
    """Ascending different hashes of the word n-grams."""
    return next(ngram_sets([text], n))


def digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def number(node: bytes) -> int:
    """The first eight bytes of a class's digest: groups are formed on these. Two
    classes with one number are only ever candidates more."""
    return int.from_bytes(node[:8], "little", signed=True)


def bands(n: int, percent: int) -> list[int]:
    """The largest sizes of the bands in which a set of ``n`` meets partners at least as large."""
    out, top = [], 2
    while top < n:
        top *= 2
    while True:
        out.append(top)
        if top >= 100 * n // percent:
            return out
        top *= 2


def apart(a: int, b: int, percent: int) -> int:
    """Elements that only one of two linked sets of ``a`` and ``b`` elements can have."""
    return (a + b) * (100 - percent) // (100 + percent)


def dealt(h: np.ndarray, top: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, digests) of the parts into which the sets of a band are dealt."""
    many = apart(top, top, percent) + 1
    many += max(4, many // 4)
    of = (h % np.uint64(many)).astype(np.int64)
    said = np.zeros(many, np.uint64)
    np.add.at(said, of, mix(h))
    band = np.uint64(top * int(_A[1]) & 0xFFFFFFFFFFFFFFFF)
    return np.bincount(of, minlength=many), mix(said + np.arange(many, dtype=np.uint64) * _A[0] + band)


def parts(h: np.ndarray, percent: int = 90) -> np.ndarray:
    """Digests of the announced parts of a set, band by band. All sets of a band are dealt
    into one number of parts. A set and a partner differ in at most ``most`` parts, so of the
    parts they share, the first in the order by elements and digest is among the first
    ``most + 1`` of either. Sets that cannot differ are equal and need no partner."""
    out, n = [], len(h)
    for top in bands(n, percent):
        most = apart(n, min(top, 100 * n // percent), percent)
        if not most:
            continue
        size, said = dealt(h, top, percent)
        out.append(said[np.lexsort((said, size))[-(most + 1):]])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sketch(h: np.ndarray, percent: int = 90) -> dict[int, np.ndarray]:
    """{band: 32-bit digests of all its parts}: two sets that link differ in no more parts of
    a band than in elements; equal digests of unlike parts only make them look nearer."""
    out = {}
    for top in bands(len(h), percent):
        _, said = dealt(h, top, percent)
        out[top] = said.astype(np.uint32)
    return out


def pack_sketch(parts_of: dict[int, np.ndarray]) -> bytes:
    return b"".join(np.array([top, len(d)], np.uint32).tobytes() + d.tobytes() for top, d in parts_of.items())


def unpack_sketch(raw: bytes) -> dict[int, np.ndarray]:
    x, at, out = np.frombuffer(raw, np.uint32), 0, {}
    while at < len(x):
        out[int(x[at])] = x[at + 2:at + 2 + x[at + 1]]
        at += 2 + int(x[at + 1])
    return out


def near_enough(sizes: list[int], sketches: list[dict[int, np.ndarray]], comps: list, asks: list[bool], percent: int) -> np.ndarray:
    """Which sets may link with one of another component: the sketches of the larger
    one's band differ in at most as many parts as linked sets of these sizes can."""
    n, number = np.array(sizes), {c: i for i, c in enumerate(dict.fromkeys(comps))}
    comp, ask = np.array([number[c] for c in comps]), np.array(asks)
    keep = np.zeros(len(n), bool)
    for top in {min(s) for s in sketches}:
        here = np.array([i for i, s in enumerate(sketches) if top in s])
        d = np.stack([sketches[i][top] for i in here])
        for i in (i for i in here if min(sketches[i]) == top):
            other = (comp[here] != comp[i]) & (n[here] <= n[i]) & (n[here] * 100 >= n[i] * percent)
            if ask.any():
                other &= ask[here] != ask[i]
            near = here[other][(d[other] != sketches[i][top]).sum(axis=1) <= (n[here[other]] + n[i]) * (100 - percent) // (100 + percent)]
            if len(near):
                keep[near] = keep[i] = True
    return keep


@frees_memory
def _needed(batches, percent: int):
    """Rows sorted by task: (g, node) of the sets that must be compared."""
    task, rows = None, []

    def out():
        if len({r["comp"] for r in rows}) < 2:
            return []
        keep = near_enough([r["n"] for r in rows], [unpack_sketch(r["sketch"]) for r in rows], [r["comp"] for r in rows], [r["ask"] for r in rows], percent)
        return [{"g": r["g"], "node": r["node"]} for r, k in zip(rows, keep) if k]

    schema = pa.schema([("g", pa.int64()), ("node", pa.binary())])
    for batch in slices(batches):
        made = []
        for r in batch.to_pylist():
            if r["task"] != task:
                made += out()
                task, rows = r["task"], []
            if not rows or (rows[-1]["node"], rows[-1]["ask"]) != (r["node"], r["ask"]):
                rows.append(r)
        yield pa.RecordBatch.from_pylist(made, schema)
    yield pa.RecordBatch.from_pylist(out(), schema)


@frees_memory
def _sets(batches, n: int):
    """A row's class (``node``, and its first eight bytes as a number)."""
    for batch in slices(batches):
        rows = []
        doc_ids, keys, texts = (batch.column(c).to_pylist() for c in ("doc_id", "key", "text"))
        for doc, key, h in zip(doc_ids, keys, ngram_sets(texts, n)):
            node = digest(h) if len(h) else None
            rows.append((doc, key, len(h), node, number(node) if node else None))
        types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["doc_id", "key", "n", "node", "h"])


@frees_memory
def _announced(batches, n: int, percent: int, wanted=None):
    """(h, g): the announced parts of the texts' classes, of ``wanted`` those that the bitmap
    admits; a task announces a class once."""
    said: set[bytes] = set()
    for batch in slices(batches):
        hs, gs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for h in ngram_sets(batch.column("text").to_pylist(), n):
            node = digest(h) if len(h) else None
            if node is None or node in said:
                continue
            said.add(node)
            g = parts(h, percent)
            if wanted is not None and len(g):
                g = g[wanted.admits(g)]
            hs.append(np.full(len(g), number(node), np.int64))
            gs.append(g)
        if len(said) > 200_000:
            said.clear()
        yield pa.record_batch([pa.array(np.concatenate(hs)), pa.array(np.concatenate(gs))], ["h", "g"])


@frees_memory
def _wanted_sets(batches, n: int, percent: int, wanted):
    for batch in slices(batches):
        keep = wanted.admits(batch.column("row").to_numpy(zero_copy_only=False))
        nodes, sets, sketches = [], [], []
        for h in ngram_sets(batch.filter(pa.array(keep)).column("text").to_pylist(), n):
            if len(h):
                nodes.append(digest(h))
                sets.append(h.tobytes())
                sketches.append(pack_sketch(sketch(h, percent)))
        yield pa.RecordBatch.from_arrays([pa.array(map(number, nodes), pa.int64()), pa.array(nodes, pa.binary()), pa.array(sets, pa.binary()),
                                          pa.array(sketches, pa.binary())], ["h", "node", "set", "sketch"])


# --- the trie -------------------------------------------------------------------------
class Node:
    """An edge of elements and what stands below it: sets ``lo`` to ``hi`` in sorted order."""

    __slots__ = ("edge", "depth", "lo", "hi", "least", "most", "ends", "children")

    def __init__(self, edge, depth, lo, hi, least, most, ends):
        self.edge, self.depth, self.lo, self.hi, self.least, self.most, self.ends = edge, depth, lo, hi, least, most, ends
        self.children = []


def build(sets: list[np.ndarray]) -> list[Node]:
    """Roots of the path-compressed trie over sets in lexicographic order, all different."""
    roots: list[Node] = []
    todo = [(0, len(sets), 0, roots)]
    while todo:
        lo, hi, depth, out = todo.pop()
        i = lo
        while i < hi:                                    # children: runs with one next element
            first, j = sets[i][depth], i + 1
            while j < hi and sets[j][depth] == first:
                j += 1
            a, b = sets[i], sets[j - 1]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[depth:m] != b[depth:m])
            end = depth + int(differ[0]) if len(differ) else m
            sizes = [len(sets[x]) for x in range(i, j)]
            node = Node(a[depth:end], depth, i, j, min(sizes), max(sizes), i if len(a) == end else None)
            out.append(node)
            if j - i > (node.ends is not None):
                todo.append((i + (node.ends is not None), j, end, node.children))
            i = j
    return roots


def reachable(overlap: int, depth: int, rest: int, size: int, least: int, most: int, percent: int) -> bool:
    """Can a set of ``least`` to ``most`` elements, ``depth`` of them passed with ``overlap``,
    still link with one of ``size`` elements of which ``rest`` are not passed?"""
    least = max(least, -(-percent * size // 100))
    most = min(most, 100 * size // percent)
    if least > most:
        return False
    best = min(max(depth + rest, least), most)           # the length that gains most
    return (100 + percent) * (overlap + min(best - depth, rest)) >= percent * (size + best)


def trie_links(sets: list[np.ndarray], labels: list | None = None, percent: int = 90, asked: list[int] | None = None):
    """Pairs (i, j) of linked sets, enough to connect all that are linked; sets with equal
    ``labels`` count as connected already. With ``asked``, only those sets are joined with the
    others (which make up the trie), not the others among themselves."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    kept = order if asked is None else [i for i in order if i not in set(asked)]
    trie = [sets[i] for i in kept]
    if labels is None:
        labels = list(range(len(sets)))
    number = {x: k for k, x in enumerate(dict.fromkeys(labels))}
    comp = np.array([number[labels[i]] for i in kept], dtype=np.int64)
    mine = [number[x] for x in labels]
    # elements as numbers in their order, so that a set is a mask and an overlap is a lookup
    every = np.unique(np.concatenate(trie)) if trie else np.zeros(0, np.uint64)
    roots = build([np.searchsorted(every, x) for x in trie])
    mask = np.zeros(len(every), dtype=bool)
    for at, i in enumerate(order if asked is None else asked):
        q = sets[i]
        size, after = len(q), at + 1 if asked is None else 0
        here = np.searchsorted(every, q)
        inside = here < len(every)
        here = here[inside][every[here[inside]] == q[inside]]
        mask[here] = True
        me = mine[i] if asked is not None else comp[at]
        stack = [(r, 0) for r in roots]
        while stack:
            node, overlap = stack.pop()
            lo = max(node.lo, after)
            if lo >= node.hi or node.least * percent > 100 * size or node.most * 100 < percent * size:
                continue
            if (comp[lo] == me) if node.hi - lo == 1 else (comp[lo:node.hi] == me).all():
                continue
            overlap += int(np.count_nonzero(mask[node.edge]))
            depth = node.depth + len(node.edge)
            if node.children:
                passed = int(np.searchsorted(q, every[node.edge[-1]], "right"))
                if not reachable(overlap, depth, size - passed, size, node.least, node.most, percent):
                    continue
                stack.extend((child, overlap) for child in node.children)
            if node.ends is not None and node.ends >= after and comp[node.ends] != me:
                if (100 + percent) * overlap >= percent * (size + depth):
                    yield i, kept[node.ends]
                    old = comp[node.ends]
                    comp[comp == old] = me
                    if asked is not None:
                        mine = [me if x == old else x for x in mine]
        mask[here] = False


@frees_memory
def _join(batches, percent: int):
    """Rows sorted by task: one trie a task; memory: the sets of one task. Rows marked
    ``ask`` are joined with the task's other rows only."""
    task, nodes, sets, labels, asks = None, [], [], [], []

    def links():
        if len(sets) < 2:
            return []
        asked = [i for i, a in enumerate(asks) if a] or None
        return [(nodes[i], nodes[j]) for i, j in trie_links(sets, labels, percent, asked)]

    for pdf in batches:
        rows = []
        for t, node, data, label, ask in zip(pdf["task"], pdf["node"], pdf["set"], pdf["label"], pdf["ask"]):
            if t != task:
                rows += links()
                task, nodes, sets, labels, asks = t, [], [], [], []
            if not nodes or nodes[-1] != node or asks[-1] != ask:    # sorted: the same set twice stands together
                nodes.append(node)
                sets.append(np.frombuffer(data, np.uint64))
                labels.append(label)
                asks.append(ask)
        yield pd.DataFrame(rows, columns=["a", "b"])
    yield pd.DataFrame(links(), columns=["a", "b"])


def _run(rows: DataFrame, percent: int) -> DataFrame:
    dealt = rows.repartition(shuffle_parts(rows.sparkSession), "task").sortWithinPartitions("task", "ask", "node")
    return stage(dealt.mapInPandas(partial(_join, percent=percent), "a binary, b binary"), "trie_links")


def _meetings(held: DataFrame, main: DataFrame, payload: DataFrame, wide: int, comp: str) -> DataFrame:
    """``held`` (g, node, comp) dealt into tasks with the ``payload`` of its nodes. Up to ``wide``
    rows of a part all meet in one task; beyond that, rows marked ``ask`` - those outside
    the part's largest component - meet its rows block by block."""
    rows = held.join(main, "g").join(payload, "node")
    rows = rows.withColumn("blocks", F.ceil(F.col("all") / wide).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spots = F.ceil((F.col("all") - F.col("top")) / wide).cast("int")
    spot = F.pmod(F.xxhash64("node", F.lit(11)), spots).cast("int")
    keep = ["g", "node", comp, *[c for c in payload.columns if c != "node"]]
    everyone = rows.select(*keep, "block", F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0), spots - 1)).otherwise(F.array(F.lit(0)))).alias("spot"),
                           F.lit(False).alias("ask"))
    outside = rows.where((F.col("blocks") > 1) & (F.col(comp) != F.col("main"))).select(
        *keep, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), spot.alias("spot"), F.lit(True).alias("ask"))
    return everyone.unionByName(outside).withColumn("task", F.concat(F.hex("g"), F.lit(":"), F.col("block"), F.lit(":"), F.col("spot")))


def link_classes(docs: DataFrame, n: int = 3, percent: int = 90, block: int = 64, bridges: int = 8, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, links): per row (doc_id as text, key of its text, n, node), where ``node`` names
    the class of its set; and pairs (a, b) of linked classes that connect every component."""
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = stage(narrow.mapInArrow(partial(_sets, n=n), "doc_id string, key long, n int, node binary, h long"), "ngram_sets")
    # the parts are many times the rest of a row: they are made again from the texts where they
    # are read, and never kept beside the shuffle that finds the shared ones
    announced = partial(_announced, n=n, percent=percent)
    hubs = (narrow.select("text").mapInArrow(announced, "h long, g long").groupBy("g").agg(F.min("h").alias("hub"), F.max("h").alias("other"))
            .where("hub <> other").select("g", "hub"))
    hubs = stage(hubs, "ngram_hubs")
    shared = narrow.select("text").mapInArrow(
        partial(announced, wanted=bitmap_of(hubs.select(F.col("g").alias("h")), "h", 24)), "h long, g long")
    met = stage(shared.join(hubs, "g"), "ngram_met")                     # every announcement of a part that classes share
    unstage(hubs)
    near = met.where("h <> hub").select("h", "hub").distinct()
    group = stage(components(near, "h", "hub").select(F.col("node").alias("h"), "root"), "ngram_groups")
    # every grouped class with its blocks, and the sets made again from the texts the bitmap admits
    large = stage(group.groupBy("root").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > block), "ngram_large")
    placed = group.join(large, "root", "left").fillna(1, ["members"]).withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    placed = stage(placed, "ngram_blocks")
    row = F.xxhash64("doc_id", "key")
    some = rows.select("h", "node", row.alias("row")).join(placed.select("h"), "h", "left_semi").groupBy("node").agg(F.min("row").alias("h"))
    wanted = bitmap_of(some, "h")
    sets = narrow.select(row.alias("row"), "text").mapInArrow(partial(_wanted_sets, n=n, percent=percent, wanted=wanted),
                                                                            "h long, node binary, set binary, sketch binary")
    sized = sets.join(placed, "h").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sized = stage(sized, "ngram_group_sets")      # a class may come twice; tasks drop the second
    for done in (group, large, placed):
        unstage(done)
    bridge = F.pmod(F.xxhash64("node", F.lit(7)), F.col("members")) < bridges
    places = F.when((F.col("blocks") > 1) & bridge, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = sized.withColumn("to", F.explode(places)).select(
        F.concat(F.hex("root"), F.lit(":"), F.col("to")).alias("task"), "node", "set", F.hex("node").alias("label"), F.lit(False).alias("ask"))
    links = _run(first, percent)
    # groups of several blocks that are not one component yet: where a part is shared by
    # classes of different components, they meet; parts of the same classes need one meeting.
    # Linked classes share a part, so a group whose parts are not mixed has no link left
    many = sized.where("blocks > 1")
    if many.isEmpty():
        for done in (sized, met):
            unstage(done)
        return rows, links
    comp = components(links, "a", "b").select("node", F.col("root").alias("comp"))
    inside = stage(many.join(comp, "node", "left").select("h", "node", "root", F.coalesce("comp", "node").alias("comp")).distinct(), "ngram_inside")
    held = met.select("h", "g").distinct().join(inside, "h")
    mixed = held.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
                                  F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    one = mixed.groupBy("n", "x", "y").agg(F.min("g").alias("g")).select("g")
    by_part = stage(held.join(one, "g"), "ngram_mixed")
    # a group meets as a whole where that is fewer rows (few classes outside its largest component)
    wide = 2 * block                     # two sides of this size meet in a task
    whole = (inside.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("size"))
             .groupBy("root").agg(F.sum("size").alias("all"), F.max("size").alias("top")).where("all > top"))
    lone = F.col("all") - F.col("top")
    cost = F.col("all") * F.ceil(lone / wide) + lone * F.ceil(F.col("all") / wide)
    whole = whole.join(by_part.groupBy("root").agg(F.count(F.lit(1)).alias("rows")), "root").where(cost <= F.col("rows")).select("root")
    whole = stage(whole, "ngram_whole")
    held = stage(by_part.join(whole, "root", "left_anti").select("g", "node", "comp")
                 .unionByName(inside.join(whole, "root", "left_semi").select(F.col("root").alias("g"), "node", "comp")), "ngram_held")
    sizes = held.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("g").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("top"))
    # first their sketches alone, which leave few sets that must be compared
    some = _meetings(held, main, many.select("node", "sketch", F.expr("length(set) div 8").cast("int").alias("n")), wide, "comp")
    some = some.repartition(shuffle_parts(spark), "task").sortWithinPartitions("task", "ask", "node")
    needed = stage(some.select("task", "g", "node", "comp", "ask", "n", "sketch").mapInArrow(partial(_needed, percent=percent), "g long, node binary")
                   .distinct(), "ngram_needed")
    second = _meetings(held.join(needed, ["g", "node"], "left_semi"), main, many.select("node", "set"), wide, "comp")
    second = second.select("task", "node", "set", F.hex("comp").alias("label"), "ask")
    more = _run(second, percent)
    for done in (sized, met, inside, by_part, whole, held, needed):
        unstage(done)
    return rows, links.unionByName(more)


def _found(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, **options) -> DataFrame:
    """(doc_id, key, n, node, component_id) of every row."""
    rows, links = link_classes(docs, n, percent, id_col=id_col, text_col=text_col, **options)
    rows = rows.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "key", "n", "node")
    comp = components(links, "a", "b").select("node", F.col("root").alias("comp"))
    low = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    low = stage(low.join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "low"), "ngram_classes")
    least = low.groupBy("comp").agg(F.min("low").alias("component_id"))
    label = low.join(least, "comp").select("node", "component_id")
    return rows.join(label, "node", "left")


def join_documents(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_shingles, component_id) per row."""
    found = _found(docs, n, percent, id_col, text_col, **options)
    return found.select(F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of every component of ``docs`` stays, the one with the smallest id.
    Rows are judged each by its own text: of two rows with one id, only the one whose
    component has a smaller id goes. A row without an id goes where its component has
    one; repeated rows of the document that stays, rows without words, and components
    without any id stay. Columns of any name pass through."""
    found = _found(docs, n, percent, id_col, text_col, **options)
    apart = F.col("component_id").isNotNull() & ~F.col("component_id").eqNullSafe(F.col("doc_id"))
    i, k = free_name(docs.columns, "gone_id"), free_name(docs.columns, "gone_key")
    gone = found.where(apart).select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(k)), "left_anti")
