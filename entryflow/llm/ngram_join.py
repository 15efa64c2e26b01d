"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of word shingles (tokens). Equal sets are one node. With a
similarity of at least t, two sets miss few of each other's tokens, so under
one global order of tokens the prefixes of both share tokens. The order has
rare tokens first; a token that no other document has costs a prefix nothing
to hold. Tokens fall into classes by document frequency, and a prefix is
indexed by combinations of k tokens of class k: single tokens where they are
rare, pairs and triples where they are frequent. A combination needs k common
tokens, so prefixes are extended: a token adds to a prefix's reach only when k - 1
others of its class stand before it. To keep combinations few, they are made
within buckets of tokens, whose number follows the band of the set's size;
a set is indexed in every band that a similar set can be in.

If e tokens of x may be missing in a similar y, a prefix whose reach is e + 1
keeps k common tokens of some class and bucket, whichever e are missing, and y's
prefix holds them too, or x's holds those of y. So no link is lost.

Candidates are not paired within a group. Parity bitmaps bound each
intersection from above. Of the pairs that can be similar, only as many are
taken as connect a group's members, fewer than members, and verified on the
sets; similar ones are joined into components. This is done twice, the second
time between components. What groups then still lie in several components
give every pair across components that the bitmaps allow: once a group's
copies are connected, few are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import (as_batch, expand, expand_keys, map_rows, mix64, shingle_hashes,
                                  squeeze, squeeze_keys, stage, tidy, utf8, word_hashes)
from entryflow.llm.graph import components

SHINGLE_WORDS, PERCENT = 5, 80
#: Tokens with a document frequency from these on are of class 2 and 3.
FREQUENT, VERY_FREQUENT = 16, 256
#: Share of hashes, in tenths, whose tokens come first in the order.
FIRST_TENTHS = 4
#: Sets with fewer tokens are similar to equal sets only (for more than 75 %).
SMALLEST = 4
#: Tokens gathered before a task hands them out, and tokens of a hash range.
GATHER, RANGE_TOKENS = 1_000_000, 1_000_000
#: Members of a tile's side, and bits of a parity bitmap.
TILE, BITMAP = 2_000, 2048
#: Pairs of a tile that are compared at a time, and 64-bit words of a bitmap compared first.
PAIRS, COARSE = 1 << 15, 6


# -- sets ------------------------------------------------------------------

def token_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    return np.unique(shingle_hashes(word_hashes(utf8(text), lower=True), k))


def node_of(tokens: np.ndarray) -> int:
    """64-bit fingerprint of a set, signed."""
    import xxhash
    h = xxhash.xxh3_64_intdigest(tokens.tobytes())
    return h - (1 << 64) if h >> 63 else h


def missing(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a similar set may lack."""
    return n - -(-percent * n // 100)


def band(n: int) -> int:
    """Bands start at powers of the square root of two."""
    return int(2 * math.log2(n) + 1e-9)


def bands(n: int, percent: int) -> range:
    """Bands in which a set similar to one of ``n`` tokens can be."""
    return range(band(-(-percent * n // 100)), band(max(n, 100 * n // percent)) + 1)


def buckets(b: int) -> int:
    return max(1, int(0.06 * 2 ** (b / 2)))


def is_first(tokens: np.ndarray) -> np.ndarray:
    return tokens % np.uint64(10) < np.uint64(FIRST_TENTHS)


def indexable(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The tokens that the set's prefixes can need, and how many of them come first."""
    n = len(tokens)
    if n < SMALLEST:
        return tokens[:0], 0
    first = is_first(tokens)
    # a bucket holds back one token of class 2 and two of class 3
    enough = missing(n, percent) + 1 + 3 * max(buckets(b) for b in bands(n, percent))
    count = int(first.sum())
    if count >= enough:
        return tokens[first], count
    more = tokens[~first][:enough - count]
    return np.concatenate([tokens[first], more]), count


def parity_bits(tokens: np.ndarray) -> bytes:
    bits = np.bincount((tokens >> np.uint64(40)) % np.uint64(BITMAP), minlength=BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


# -- document frequency classes --------------------------------------------

def _hand_out(nodes: list[int], sets: list[np.ndarray], ranges: int) -> Iterator[tuple]:
    """Rows ``part, tokens, owners, nodes, weights`` of gathered sets.

    A token that is very frequent among them already goes, with its owners, to
    a part of its own kind (``ranges`` and up, spread by owner); its range
    gets its weight only.
    """
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    table = np.array(nodes, dtype=np.int64).view(np.uint64)
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    length = np.diff(np.append(start, len(tokens)))
    hot = np.repeat(length >= VERY_FREQUENT, length)
    marks, weights = tokens[start][length >= VERY_FREQUENT], length[length >= VERY_FREQUENT]

    def row(part, t, o, m, w):
        used, local = np.unique(o, return_inverse=True)
        return (part, squeeze_keys(t), squeeze(local), squeeze(table[used]), squeeze_keys(m), squeeze(w))

    t, o = tokens[~hot], owner[~hot]
    to, mark_to = _range_of(t, ranges), _range_of(marks, ranges)
    for part in np.union1d(to, mark_to):
        a, b = np.searchsorted(to, [part, part + 1])
        c, d = np.searchsorted(mark_to, [part, part + 1])
        yield row(int(part), t[a:b], o[a:b], marks[c:d], weights[c:d])
    t, o = tokens[hot], owner[hot]
    spread = _range_of(mix64(table[o]), ranges)
    for part in np.unique(spread):
        here = spread == part
        yield row(ranges + int(part), t[here], o[here], marks[:0], weights[:0])


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _classes(group: pa.Table, ranges: int) -> pa.Table:
    """Class of every token of a range that several nodes hold (of later tokens, of all)."""
    tokens, owners, marks, weights = [], [], [], []
    for r in group.to_pylist():
        table = expand(r["nodes"])
        tokens.append(expand_keys(r["tokens"]))
        owners.append(table[expand(r["owners"]).astype(np.int64)] if len(table) else table)
        marks.append(expand_keys(r["marks"]))
        weights.append(expand(r["weights"]).astype(np.int64))
    t, o = np.concatenate(tokens), np.concatenate(owners)
    order = np.lexsort((o, t))
    t, o = t[order], o[order]
    if len(t):  # copies in different tasks hold the same pair
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (o[1:] != o[:-1])])
        t, o = t[new], o[new]
    if group["part"][0].as_py() >= ranges:
        kind = np.full(len(t), 3)
    else:
        found, inverse, count = np.unique(t, return_inverse=True, return_counts=True)
        m, w = np.concatenate(marks), np.concatenate(weights)
        at = np.searchsorted(found, m)
        known = at < len(found)
        known[known] = found[at[known]] == m[known]
        np.add.at(count, at[known], w[known])
        count = count[inverse]
        kind = 1 + (count >= FREQUENT) + (count >= VERY_FREQUENT)
        keep = (count > 1) | ~is_first(t)
        t, o, kind = t[keep], o[keep], kind[keep]
    return pa.table({"node": pa.array(o.view(np.int64)), "token": pa.array(t.view(np.int64)),
                     "kind": pa.array(kind.astype(np.int32))})


def token_classes(docs: DataFrame, n_tokens: int, k: int, percent: int) -> DataFrame:
    """``node long, token long, kind int`` of the indexable tokens that matter."""
    ranges = max(1, -(-n_tokens // RANGE_TOKENS))
    schema = pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in
                                                 ("tokens", "owners", "nodes", "marks", "weights")])

    def run(batches):
        seen: set[int] = set()
        nodes, sets, held = [], [], 0

        def flush():
            rows = list(zip(*_hand_out(nodes, sets, ranges)))
            return as_batch(dict(zip(schema.names, rows)), schema)

        for b in batches:
            for text in b.column(0).to_pylist():
                tokens = token_set(text, k)
                node = node_of(tokens)
                index, _ = indexable(tokens, percent)
                if not len(index) or node in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                sets.append(index)
                held += len(index)
                if held >= GATHER:
                    yield flush()
                    nodes, sets, held = [], [], 0
        if sets:
            yield flush()

    handed = docs.select("text").mapInArrow(
        tidy(run), "part int, tokens binary, owners binary, nodes binary, marks binary, weights binary")
    return handed.groupBy("part").applyInArrow(lambda g: _classes(g, ranges),
                                               "node long, token long, kind int")


# -- signatures ------------------------------------------------------------

def signatures(n: int, n_first: int, tokens: np.ndarray, kinds: np.ndarray,
               percent: int) -> list[tuple[int, ...]]:
    """(band, kind, tokens...) combinations of a set's prefixes.

    ``tokens``: those of ``token_classes``. Of the ``n_first`` tokens that come
    first, the others are held by no other node and lead the order.
    """
    need = missing(n, percent) + 1
    first = is_first(tokens)
    alone = n_first - int(first.sum())
    if alone >= need:
        return []
    order = np.concatenate([np.lexsort((tokens, kinds, ~first))[:first.sum()],
                            np.lexsort((tokens, first))[:(~first).sum()]])
    ordered = list(zip(tokens[order].tolist(), kinds[order].tolist()))
    out: list[tuple[int, ...]] = []
    for b in bands(n, percent):
        reach, size, groups = alone, buckets(b), {}
        for token, kind in ordered:
            members = groups.setdefault((kind, (token >> 17) % size if kind > 1 else token), [])
            members.append(token)
            reach += len(members) >= kind
            if reach >= need:
                break
        else:
            raise RuntimeError(f"a set of {n} tokens ran out of indexable tokens")
        for (kind, _), members in groups.items():
            out += [(b, kind, *c) for c in combinations(sorted(members), kind)]
    return out


def _signature_rows(heads: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``sig long, node long, n long`` of all nodes; heads: ``node, n, n_first``."""
    head = heads.select("node", F.shiftleft(F.col("n"), 32).bitwiseOR(F.col("n_first"))
                        .alias("token"), F.lit(0).alias("kind"))
    rows = (head.union(classes.select("node", "token", "kind"))
            .repartition("node").sortWithinPartitions("node", "kind", "token"))
    schema = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def one(tokens, kinds):
        size = int(tokens[0])
        n, n_first = size >> 32, size & 0xFFFFFFFF
        t, at = np.unique(tokens[kinds > 0].view(np.uint64), return_index=True)
        return n, signatures(n, n_first, t, kinds[kinds > 0][at], percent)

    def run(batches):
        rest = [np.empty(0, np.int64)] * 3
        for b in _with_end(batches):
            if b is not None:
                rest = [np.concatenate([r, b.column(i).to_numpy()]) for i, r in enumerate(rest)]
            node, token, kind = rest
            if not len(node):
                continue
            cuts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
            if b is not None:
                cuts = cuts[:-1]  # the last node may go on
            sig, of, size = [], [], []
            for a, z in zip(cuts[:-1], cuts[1:]):
                if kind[a] != 0:
                    raise RuntimeError("tokens without a head")
                n, found = one(token[a:z], kind[a:z])
                if found:
                    wide = np.zeros((len(found), 5), dtype=np.uint64)
                    for i, s in enumerate(found):
                        wide[i, :len(s)] = s
                    acc = np.zeros(len(found), dtype=np.uint64)
                    for c in range(5):
                        acc = mix64(acc * np.uint64(0x9E6C63D0876A3F35) + wide[:, c])
                    acc = np.unique(acc)
                    sig.append(acc.view(np.int64))
                    of.append(np.full(len(acc), node[a]))
                    size.append(np.full(len(acc), n))
            rest = [r[cuts[-1]:] for r in rest]
            if sig:
                yield as_batch({"sig": np.concatenate(sig), "node": np.concatenate(of),
                                "n": np.concatenate(size)}, schema)

    return rows.mapInArrow(tidy(run), "sig long, node long, n long")


def _with_end(batches):
    yield from batches
    yield None


# -- verification ----------------------------------------------------------

def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar."""
    def run(cols):
        out = {"a": [], "b": []}
        last, left = None, None
        for a, b, sa, sb in zip(cols["a"], cols["b"], cols["sa"], cols["sb"]):
            if a != last:
                last, left = a, expand_keys(sa)
            if similar(left, expand_keys(sb), percent):
                out["a"].append(a)
                out["b"].append(b)
        return out

    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("sb"))
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("sa"))
    return map_rows(pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb"), run,
                    "a long, b long")


def possible_pairs(label: np.ndarray, n: np.ndarray, bits: np.ndarray, chunk: np.ndarray,
                   percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of different labels that sizes and bitmaps allow to be similar.

    Where members of two chunks are given, only pairs across the chunks count.
    """
    m = len(label)
    two = m > 0 and chunk.min() != chunk.max()
    step, out = max(1, PAIRS // max(1, m)), [(np.empty(0, np.int64),) * 2]
    for a in range(0, m, step):
        rows = np.arange(a, min(m, a + step))[:, None]
        ok = (np.arange(m) > rows) & (label != label[rows])
        ok &= 100 * np.minimum(n, n[rows]) >= percent * np.maximum(n, n[rows])
        if two:
            ok &= chunk != chunk[rows]
        i, j = np.nonzero(ok)
        i += a
        for words in (COARSE, bits.shape[1]):  # part of a bitmap bounds less tightly, but fast
            total = n[i] + n[j]
            apart = np.bitwise_count(bits[i, :words] ^ bits[j, :words]).sum(1, dtype=np.int64)
            both = np.minimum((total - apart) // 2, np.minimum(n[i], n[j]))
            stay = 100 * both >= percent * (total - both)
            i, j = i[stay], j[stay]
        out.append((i, j))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def spanning(m: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than ``m`` of the pairs that connect all that they connect."""
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    start = np.searchsorted(a, np.arange(m + 1))
    left = np.ones(m, dtype=bool)
    one, many = [], []
    for first in np.unique(a).tolist():
        queue = [first] if left[first] else []
        left[first] = False
        while queue:
            x = queue.pop()
            near = b[start[x]:start[x + 1]]
            near = near[left[near]]
            if len(near):
                left[near] = False
                one.append(np.full(len(near), x))
                many.append(near)
                queue += near.tolist()
    return np.concatenate(one or [i[:0]]), np.concatenate(many or [i[:0]])


def _group_pairs(members: DataFrame, groups: DataFrame, sets: DataFrame, percent: int,
                 connecting: bool) -> DataFrame:
    """Distinct pairs ``a, b`` of one group, of different labels, that can be similar.

    ``members``: ``sig, node, n, label``; ``groups``: ``sig, m``. A group is cut
    into chunks by node, and each pair of chunks is a tile, so no task holds
    a whole large group. ``connecting``: only as many pairs as connect a
    tile's members.
    """
    parts = groups.select("sig", F.ceil(F.col("m") / TILE).cast("int").alias("t"))
    chunk = F.pmod(F.xxhash64("node"), F.col("t")).cast("int")
    rows = (members.join(parts, "sig").withColumn("chunk", chunk)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
            .join(sets.select("node", "bits"), "node")
            .select("sig", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                    "chunk", "node", "label", "n", "bits")
            .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held = None
        for b in _with_end(batches):
            if b is not None:
                held = pa.Table.from_batches([b]) if held is None else \
                    pa.concat_tables([held, pa.Table.from_batches([b])])
            if held is None or not held.num_rows:
                continue
            held = held.combine_chunks()
            key = np.stack([held[c].to_numpy() for c in ("sig", "i", "j")])
            cuts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0), [True]]))
            if b is not None:
                cuts = cuts[:-1]  # the last tile may go on
            columns = [held[c].to_numpy() for c in ("node", "label", "n", "chunk")]
            bits = np.frombuffer(b"".join(held["bits"].to_pylist()), dtype=np.uint64).reshape(len(key[0]), -1)
            found = []
            for a, z in zip(cuts[:-1], cuts[1:]):
                node, label, n, chunk = (c[a:z] for c in columns)
                i, j = possible_pairs(label, n, bits[a:z], chunk, percent)
                if connecting and len(i):
                    i, j = spanning(z - a, i, j)
                found.append((np.minimum(node[i], node[j]), np.maximum(node[i], node[j])))
            held = held.slice(cuts[-1])
            if found:
                yield as_batch({"a": np.concatenate([f[0] for f in found]),
                                "b": np.concatenate([f[1] for f in found])}, schema)

    return stage(rows.mapInArrow(tidy(run), "a long, b long").distinct(), "join_pairs")


def _still_mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members under their component's label, and the groups that lie in several."""
    members = stage(members.drop("label").join(labels.withColumnRenamed("label", "known"), "node", "left")
                    .withColumn("label", F.coalesce("known", "node")).drop("known"), "join_labelled")
    mixed = (members.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                        F.count(F.lit(1)).alias("m"))
             .where("x <> y").select("sig", "m"))
    return members, stage(mixed, "join_mixed")


# -- the join --------------------------------------------------------------

def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, percent: int = PERCENT,
                    row_col: str | None = None) -> DataFrame:
    """``row long, id long, n_shingles long, component_id long`` of every row.

    ``row`` is ``row_col``, or null.

    ``component_id`` is the least id reachable by links, its own included. A
    null or empty text, or one without words, has no shingles and no links.
    Rows with a null id have a null component and link nothing; repeated
    rows are returned repeatedly, in one component; an empty table gives no
    rows. ``percent`` is over 75.
    """
    if percent <= 75:
        raise ValueError("sets of few tokens need a similarity of more than 75 percent")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"))

    def mark(cols):
        out = {"row": cols["row"], "id": cols["id"], "node": [], "n": [], "n_first": [], "n_index": []}
        for text in cols["text"]:
            tokens = token_set(text, k)
            index, first = indexable(tokens, percent)
            for c, v in (("node", node_of(tokens) if len(tokens) else None), ("n", len(tokens)),
                         ("n_first", first), ("n_index", len(index))):
                out[c].append(v)
        return out

    marks = stage(map_rows(rows, mark, "row long, id long, node long, n long, n_first long, "
                                 "n_index long"),
                  "join_marks")
    with_id = rows.where("id is not null")
    heads = stage(marks.where("id is not null and node is not null").groupBy("node")
                  .agg(F.min("id").alias("id"), F.first("n").alias("n"),
                       F.first("n_first").alias("n_first"), F.first("n_index").alias("n_index")),
                  "join_heads")
    n_tokens = heads.agg(F.sum("n_index")).first()[0] or 0
    classes = token_classes(with_id, n_tokens, k, percent)
    sigs = stage(_signature_rows(heads.where(F.col("n") >= SMALLEST), classes, percent), "join_sigs")

    # groups with the same members are one group
    groups = (sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("least"),
                                      F.bit_xor(F.xxhash64("node")).alias("x"))
              .where("m > 1").groupBy("m", "least", "x").agg(F.min("sig").alias("sig")))
    groups = stage(groups.select("sig", "m"), "join_groups")
    members = stage(sigs.join(groups.select("sig"), "sig"), "join_members")
    needed = members.select("node").distinct().join(heads.select("node", "id"), "node").select("id")
    sets = stage(_sets(with_id.join(stage(needed, "join_needed"), "id", "left_semi"), k), "join_sets")

    members, links = members.withColumn("label", F.col("node")), None
    for connecting in (True, True, False):
        found = verified(_group_pairs(members, groups, sets, percent, connecting), sets, percent)
        links = stage(found if links is None else links.union(found), "join_links")
        labels = components(links)
        if connecting:
            members, groups = _still_mixed(members, labels)
    named = (heads.select("node", "id").join(labels, "node", "left")
             .select("node", "id", F.coalesce("label", "node").alias("label")))
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = stage(named.join(least, "label").select("node", "component_id"), "join_named")
    joined = marks.join(of_node, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select("row", "id", F.col("n").alias("n_shingles"),
                         component.alias("component_id"))


def _sets(rows: DataFrame, k: int) -> DataFrame:
    """``node, n, tokens, bits``, one row a node."""
    def run(cols):
        out = {"node": [], "n": [], "tokens": [], "bits": []}
        for text in cols["text"]:
            tokens = token_set(text, k)
            for c, v in (("node", node_of(tokens)), ("n", len(tokens)),
                         ("tokens", squeeze_keys(tokens)), ("bits", parity_bits(tokens))):
                out[c].append(v)
        return out

    return map_rows(rows.select("text"), run, "node long, n long, tokens binary, bits binary") \
        .dropDuplicates(["node"])
