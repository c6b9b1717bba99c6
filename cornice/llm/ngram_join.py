"""Jaccard join on word n-grams with token-combination prefixes.

A document's set holds a 64-bit hash of each distinct n-gram.  Linked sets A and
B share at least ``need(size)`` tokens, so their prefixes by hash of length
``size - need(size) + k`` share k.  k is large here (EXTEND of the plain prefix):
a passage that many documents share gives them some tokens in common, but not k.

1. Tokens of the extended prefixes are counted.  Those in very many documents
   are frequent, FREQUENT_MOST at most, so that every task can know them.  The
   rest are rare; they meet in a shuffle, which tells each document which of its
   prefix tokens occur elsewhere at all.  Documents with fewer than k such
   tokens have no partner and go.
2. What a document shares is put in a common order, rare tokens first by number
   of documents, frequent ones last.  As partners have k of them in common, all
   but the last k - c hold c common ones.  Of that second prefix every rare
   token is indexed alone, and frequent ones in combinations of c tokens.
   (Sets above COMBINED_SIZES tokens index frequent tokens alone, c = 1; sizes
   near that bound do both, so that no pair falls between.)
3. Classes under one key are tied by stars: each task hangs those that it has
   seen on their least one, and only least ones meet in the shuffle, so a key in
   a third of all documents costs a row per task and pairs within a group are
   never made.  Classes with any tie are in play, and their whole sets are read.
4. Among the sets in play the same is done once more with their whole sets:
   tokens are put in the order of the number of sets in play that hold them, and
   of what a set shares with any other all but the last need - 1 tokens are
   indexed alone.  Documents that share a passage, but little else, part here.
5. Connected parts of that second graph are checked exactly, in blocks of at most
   BLOCK_ROWS sets and `block_tokens` tokens (see link_block).  A part of several
   blocks is tied together through hubs, the best linked sets of HUBS blocks,
   which are compared with all others; then only the sets outside of the largest
   piece are compared with the rest.  No link is lost, and comparisons are of
   whole sets.

Documents with equal sets form a class, of which one stands for all.

Defined cases: a null or empty text has an empty set, links with nothing and is
its own component; a text with fewer words than n has one shingle, the whole
sequence; a null doc_id is never the smallest unless all are null; repeated rows
fall into one class; several texts of one doc_id are judged each by itself.  An
empty table gives no rows.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import _stars, components
from .store import materialize, tasks_for
from .text_hash import mix64, padded, parts, raw_bytes, slices, word_hashes

#: No more tokens than this count as frequent, so that they can be sent to every task.
FREQUENT_MOST = 1 << 20
#: A token in fewer documents than this is never frequent.
FREQUENT_LEAST = 48
#: In-play classes up to this number are broadcast to the scan (40 bytes each).
BROADCAST_ROWS = 500_000
#: Tenths of the plain prefix that the extended one adds.
EXTEND = 7
#: Sizes of sets whose frequent tokens are indexed in combinations.
COMBINED_SIZES = (40, 600)
COMBINED = 2
#: Edges that a task holds to make them distinct (16 bytes each).
MEET_EDGES = 1 << 21
#: Rows of one token that a task holds to count them; beyond, all have this count.
HELD_ROWS = 1 << 20
#: Sets of a block, blocks that are one in the last comparison, and hubs of a part.
BLOCK_ROWS = 512
JOINED_BLOCKS = 16
HUBS = 16
#: In link_block: sets compared with all others, and how many in a row may find little.
PIVOTS = 64
FRUITLESS = 4
#: Classes in more documents than a share of this of all have their result broadcast; there are no more of them than this.
HOT_CLASSES = 1 << 17
HOT_ROWS = 10_000
_A = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xA0761D6478BD642F)


def need(size: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of this size with any set it links with."""
    return -(-size * percent // 100)


def plain_prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size - need(size, percent) + 1


def shared_tokens(size: np.ndarray, percent: int) -> np.ndarray:
    """k: tokens that the extended prefixes of linked sets of this size or more have in common."""
    return np.maximum(1, plain_prefix(size, percent) * EXTEND // 10)


class Sets:
    """The token sets of some rows: tokens of row i are tokens[at[i]:at[i+1]], ascending."""

    def __init__(self, column: pa.Array, n: int):
        data, ends = raw_bytes(column)
        toks, sizes = [], []
        for i, j in slices(ends):
            buf, starts = padded(data, ends, i, j)
            h, begin, _ = word_hashes(buf)
            row = np.searchsorted(starts, begin, side="right") - 1
            count = np.bincount(row, minlength=j - i)
            with np.errstate(over="ignore"):
                t = np.zeros(0, np.uint64)
                r = np.zeros(0, np.int64)
                if len(h) >= n:
                    t = h[: len(h) - n + 1].copy()
                    for k in range(1, n):
                        t = t * _A + h[k : len(h) - n + 1 + k]
                    whole = row[: len(h) - n + 1] == row[n - 1 :]
                    t, r = t[whole], row[: len(h) - n + 1][whole]
                # Rows with fewer words than n: their whole sequence.
                first = np.concatenate(([0], np.cumsum(count)[:-1]))
                short = np.flatnonzero((count > 0) & (count < n))
                if len(short):
                    s = np.zeros(len(short), np.uint64)
                    for k in range(n - 1):
                        has = count[short] > k
                        s[has] = s[has] * _A + h[first[short[has]] + k]
                    t = np.concatenate((t, s ^ (_SALT * count[short].astype(np.uint64))))
                    r = np.concatenate((r, short))
            t = mix64(t)
            order = np.lexsort((t, r))
            t, r = t[order], r[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
            toks.append(t[new])
            sizes.append(np.bincount(r[new], minlength=j - i))
        self.tokens = np.concatenate(toks) if toks else np.zeros(0, np.uint64)
        self.size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.row = np.repeat(np.arange(len(self.size)), self.size)

    def digest(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that tell each set, as two signed columns."""
        out = []
        for salt in (np.uint64(0), _SALT):
            sums = np.zeros(len(self.tokens) + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(mix64(self.tokens ^ salt), out=sums[1:])
                out.append(mix64(sums[self.at[1:]] - sums[self.at[:-1]] + self.size.astype(np.uint64)).view(np.int64))
        return out[0], out[1]

    def head(self, length: np.ndarray) -> np.ndarray:
        """Which tokens are among the first so many of their set."""
        return np.arange(len(self.tokens)) - self.at[self.row] < length[self.row]


def _useful(sets: Sets, ck: np.ndarray, percent: int) -> np.ndarray:
    """Tokens in the extended prefix of one set of each class; sets so small that only equal ones link are left out."""
    _, one = np.unique(ck, return_index=True)
    chosen = np.zeros(len(ck), bool)
    chosen[one] = True
    chosen &= sets.size * (100 - percent) >= percent
    depth = plain_prefix(sets.size, percent) - 1 + shared_tokens(sets.size, percent)
    return sets.head(depth) & chosen[sets.row]


def _count_tokens(n: int, percent: int):
    """Documents per token of the extended prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 0):
            sets = Sets(batch.column(0), n)
            tok, count = np.unique(sets.tokens[_useful(sets, sets.digest()[0], percent)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(count.astype(np.int64))], ["token", "n"])

    return run


#: kind 0: a rare token (a) of a class (b) of size c; 2: class a, b of size c of document d; 3: class a has frequent token b, size c.
#: kind 4: as 2, for a null doc_id; d is a hash of the text.
_ROWS = "kind int, a long, b long, c long, d long"


def _rows(kind: int, a, b, c=None, d=None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    arrays = [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)]
    arrays += [none if x is None else x.cast(pa.int64()) if isinstance(x, pa.Array) else pa.array(x.astype(np.int64)) for x in (c, d)]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "a", "b", "c", "d"])


def _entries(n: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in parts(batches, 1):
            sets = Sets(batch.column(1), n)
            ck, ck2 = sets.digest()
            unnamed = batch.column(2).to_numpy(zero_copy_only=False)
            for kind, pick in ((2, ~unnamed), (4, unnamed)):
                yield _rows(kind, ck[pick], ck2[pick], sets.size[pick], batch.column(0).filter(pa.array(pick)))
            pick = _useful(sets, ck, percent)
            tok, row = sets.tokens[pick], sets.row[pick]
            is_often = np.zeros(len(tok), bool)
            if len(often):
                is_often = often[np.minimum(np.searchsorted(often, tok), len(often) - 1)] == tok
            rare = ~is_often
            yield _rows(0, tok[rare].view(np.int64), ck[row[rare]], sets.size[row[rare]])
            yield _rows(3, ck[row[is_often]], tok[is_often].view(np.int64), sets.size[row[is_often]])

    return run


def _runs(key: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return new


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by kind, a and b: kind 0 becomes kind 1 (class a, token b, size c, documents d) if over one class has the token.

    d only serves to order tokens, so a token of very many rows needs no exact
    count: from HELD_ROWS rows on, they go out as they come.
    """
    held: list[np.ndarray] = []  # token, class and size of rows of the token that the last batch ended in
    size, over, last = 0, False, None  # rows held, whether that token has too many, its last class

    def emit(rows: np.ndarray, many: bool) -> pa.RecordBatch:
        tok, ck, n = rows
        run = np.cumsum(_runs(tok)) - 1
        df = np.full(len(tok), HELD_ROWS) if many else np.bincount(run)[run] if len(run) else run
        pick = df > 1
        return _rows(1, ck[pick], tok[pick], n[pick], df[pick])

    for batch in batches:
        kind = batch.column(0).to_numpy()
        yield batch.filter(pa.array(kind != 0))
        rows = np.stack([batch.column(i).filter(pa.array(kind == 0)).to_numpy().astype(np.int64) for i in (1, 2, 3)])
        if not rows.shape[1]:
            continue
        new = _runs(rows[0]) | _runs(rows[1])
        if last is not None:
            new[0] = (rows[0, 0], rows[1, 0]) != last
        last = (rows[0, -1], rows[1, -1])
        rows = rows[:, new]
        if not rows.shape[1]:
            continue
        if held or over:
            now = held[0][0, 0] if held else over_token
            go = int(np.searchsorted(rows[0], now, side="right"))
            if over:
                yield emit(rows[:, :go], True)
            elif go:
                held.append(rows[:, :go])
                size += go
            rows = rows[:, go:]
            if rows.shape[1] and held:
                yield emit(np.concatenate(held, axis=1), False)
            if rows.shape[1]:
                held, size, over = [], 0, False
        if rows.shape[1]:
            at = int(np.searchsorted(rows[0], rows[0, -1], side="left"))
            yield emit(rows[:, :at], False)
            held, size = [rows[:, at:]], rows.shape[1] - at
        if size >= HELD_ROWS:
            yield emit(np.concatenate(held, axis=1), True)
            over_token, over, held, size = held[0][0, 0], True, [], 0
    if held:
        yield emit(np.concatenate(held, axis=1), False)


def _index(percent: int, whole: bool = False):
    """Of rows sorted by class, kind, documents and token: (key, class) for every index key.

    whole: the rows are of whole sets, of which linked ones share need(size).
    """

    def keys(tok: np.ndarray, rare: np.ndarray, size: int) -> np.ndarray:
        if whole:
            return tok[: max(0, len(tok) - int(need(size, percent)) + 1)]
        least, smaller = (int(shared_tokens(x, percent)) for x in (need(size, percent), need(need(size, percent), percent)))
        if len(tok) < least:
            return tok[:0]
        low, high = COMBINED_SIZES
        out = []
        # Alone if the set, or any that it may link with, indexes no combinations.
        if size * percent <= low * 100 or size * 100 > high * percent or smaller < COMBINED:
            out.append(tok[: len(tok) - least + 1])
        if low < size <= high and least >= COMBINED:
            head = slice(0, len(tok) - least + COMBINED)
            out += [tok[head][rare[head]], _combine(tok[head][~rare[head]], COMBINED)]
        return np.concatenate(out) if out else tok[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def close(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not len(table):  # a batch that one class fills
                return
            kind, ck, tok, size = (table.column(i).to_numpy() for i in range(4))
            tok = tok.view(np.uint64)
            bound = np.flatnonzero(_runs(ck))
            found, owner = [], []
            for i, j in zip(bound, np.append(bound[1:], len(ck)), strict=True):
                got = keys(tok[i:j], kind[i:j] == 1, int(size[i]))
                found.append(got)
                owner.append(np.full(len(got), ck[i]))
                if sum(map(len, found)) > 1_000_000:
                    yield from star(np.concatenate(found), np.concatenate(owner))
                    found, owner = [], []
            if found:
                yield from star(np.concatenate(found), np.concatenate(owner))

        def star(key: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
            key = key.view(np.int64)
            order = np.lexsort((own, key))
            key, own = key[order], own[order]
            new = _runs(key)
            hub = own[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] if len(key) else own
            yield _rows(0, key[new], own[new])
            differ = own != hub
            pairs = np.unique(np.stack((own[differ], hub[differ])), axis=1)
            yield _rows(1, pairs[0], pairs[1])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if held is not None else now
            if not len(now):
                continue
            ck = now.column(1).to_numpy()
            last = int(np.searchsorted(ck, ck[-1], side="left"))
            yield from close(now.slice(0, last))
            held = now.slice(last).combine_chunks()
        if held is not None:
            yield from close(held)

    return run


def _combine(tokens: np.ndarray, k: int) -> np.ndarray:
    """Keys of all combinations of k tokens, made level by level."""
    keys, last = tokens.copy(), np.arange(len(tokens))
    for _ in range(k - 1):
        left = len(tokens) - 1 - last
        base = np.repeat(np.arange(len(keys)), left)
        step = np.arange(len(base)) - np.repeat(np.cumsum(left) - left, left)
        last = last[base] + 1 + step
        with np.errstate(over="ignore"):
            keys = mix64(keys[base] * _A + tokens[last])
    return mix64(keys ^ _SALT) if k > 1 else keys


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by kind, a and b: edges that connect what the task's edges and keys tie; each key's classes hang on its least.

    Partners meet under many keys, so edges are held and made a forest over the
    task: a row for each class but one of a piece.  What MEET_EDGES edges leave
    comes out when that is much.
    """
    key_now, hub_now = None, None
    held, size = [], 0
    for batch in batches:
        kind = batch.column(0).to_numpy()
        left, right = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        edge, pick = kind != 0, kind == 0
        if edge.any():
            held.append(np.stack((left[edge], right[edge])))
            size += int(edge.sum())
        key, ck = left[pick], right[pick]
        if len(key):
            new = _runs(key)
            hub = ck[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            if key[0] == key_now:
                hub[: np.flatnonzero(new)[1] if new.sum() > 1 else len(key)] = hub_now
            key_now, hub_now = key[-1], hub[-1]
            differ = ck != hub
            held.append(np.stack((ck[differ], hub[differ])))
            size += int(differ.sum())
        if size >= MEET_EDGES:
            forest = _stars(np.concatenate(held, axis=1))
            held, size = [np.stack((forest.column(0).to_numpy(), forest.column(1).to_numpy()))], len(forest)
            if size >= MEET_EDGES // 2:
                yield _rows(1, forest.column(0), forest.column(1))
                held, size = [], 0
    if held:
        forest = _stars(np.concatenate(held, axis=1))
        yield _rows(1, forest.column(0), forest.column(1))


def link_block(tokens: list[np.ndarray], label: np.ndarray, percent: int, probe: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merge labels over all links among the sets; with probe, over those that a probe set is in at least.

    Returns the label of each set, merged labels having become the least of them,
    and how many links each set was seen to have.  Links between sets of one
    label needn't be known, so:

    - pivots, central sets outside of the largest label, are compared with all
      sets as long as that finds links; a group of near copies is one label then;
    - sets outside of the largest label look at those that share one of their
      rarest tokens (all but the last need - 1) and have another label.  The
      Jaccard distance is a metric: sets whose distances from a pivot differ by
      more than a link allows are left out.
    """
    m = len(tokens)
    size = np.array([len(t) for t in tokens], dtype=np.int64)
    degree = np.zeros(m, np.int64)
    if m < 2:
        return label, degree
    owner = np.repeat(np.arange(m), size)
    _, code, df = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    # Tokens of one set alone aside, codes ascend with the number of sets.
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    alone = int((df == 1).sum())
    code = rank[code] - alone
    owner, code = owner[code >= 0], code[code >= 0]
    order = np.lexsort((code, owner))
    code = code[order]  # owner is ascending already
    df = np.sort(df)[alone:]
    have = np.bincount(owner, minlength=m)
    at = np.concatenate(([0], np.cumsum(have)))
    names, root = np.unique(label, return_inverse=True)
    mark = np.zeros(len(df), bool)
    far = 1 - percent / 100 + 1e-9

    def shared_with(i: int, others: np.ndarray | None = None) -> np.ndarray:
        mine = code[at[i] : at[i + 1]]
        mark[mine] = True
        if others is None or have[others].sum() * 4 > len(code):
            out = np.bincount(owner[mark[code]], minlength=m)
            out = out if others is None else out[others]
        else:
            span = have[others]
            reach = np.repeat(at[others] - (np.cumsum(span) - span), span) + np.arange(span.sum())
            out = np.bincount(np.repeat(np.arange(len(others)), span)[mark[code[reach]]], minlength=len(others))
        mark[mine] = False
        return out

    def merge(groups: np.ndarray) -> None:
        if len(groups) > 1:
            root[np.isin(root, groups)] = groups.min()

    central = np.bincount(owner, weights=df[code], minlength=m) / np.maximum(size, 1)
    distance, tried, fruitless = [], np.zeros(m, bool), 0
    while len(distance) < PIVOTS and fruitless < FRUITLESS:
        largest = np.bincount(root).argmax()
        if (root == largest).all():
            return names[root], degree
        choice = np.where(tried | (root == largest) & bool(distance), -1.0, central)
        i = int(choice.argmax())
        if choice[i] < 0:
            break
        shared = shared_with(i)
        union = size + size[i] - shared
        near = (100 * shared >= percent * union) & (shared > 0)
        near[i] = False
        distance.append(1 - shared / np.maximum(union, 1))
        tried[i] = True
        degree += near
        degree[i] += near.sum()
        fresh = near & (root != root[i])
        fruitless = 0 if fresh.sum() > m // 256 else fruitless + 1
        merge(np.unique(np.append(root[near], root[i])))
    distance = np.array(distance)

    largest = np.bincount(root).argmax()
    head = np.arange(len(code)) - at[owner] < (have - need(size, percent) + 1)[owner]
    entry, who = code[head], owner[head]
    order = np.argsort(entry, kind="stable")
    entry, who = entry[order], who[order]
    if not len(entry):
        return names[root], degree
    # Tokens whose sets all have one label tell nothing.
    begin = np.flatnonzero(_runs(entry))
    mixed = np.minimum.reduceat(root[who], begin) != np.maximum.reduceat(root[who], begin)
    use = np.repeat(mixed, np.diff(np.append(begin, len(entry))))
    entry, who = entry[use], who[use]
    back = np.argsort(who, kind="stable")  # entries by set
    mine = np.searchsorted(who[back], np.arange(m + 1))
    lo, hi = np.searchsorted(entry, entry, side="left"), np.searchsorted(entry, entry, side="right")
    done = np.zeros(m, bool)
    ask = (root != largest) if probe is None else probe
    for i in np.flatnonzero(ask & (np.diff(mine) > 0)):
        done[i] = True
        of = back[mine[i] : mine[i + 1]]
        span = hi[of] - lo[of]
        reach = np.repeat(lo[of] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        others = np.unique(who[reach])
        others = others[~done[others] & (root[others] != root[i])]
        others = others[(100 * size[others] >= percent * size[i]) & (100 * size[i] >= percent * size[others])]
        if len(distance) and len(others):
            others = others[np.abs(distance[:, others] - distance[:, i : i + 1]).max(axis=0) <= far]
        if not len(others):
            continue
        shared = shared_with(i, others)
        near = others[100 * shared >= percent * (size[others] + size[i] - shared)]
        if len(near):
            degree[i] += len(near)
            degree[near] += 1
            merge(np.unique(np.append(root[near], root[i])))
    return names[root], degree


_SET_SCHEMA = "ck long, n long, toks binary"


def _full_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)  # classes that this task has given
        for batch in parts(batches, 0):
            want = batch.column(1).to_numpy()
            sets = Sets(batch.column(0), n)
            ck, _ = sets.digest()
            same = np.flatnonzero((ck == want) & ~np.isin(ck, seen))  # a repeated doc_id may bring another text
            same = same[np.unique(ck[same], return_index=True)[1]]
            seen = np.concatenate((seen, ck[same]))
            toks = [sets.tokens[sets.at[i] : sets.at[i + 1]].tobytes() for i in same]
            yield pa.RecordBatch.from_arrays([pa.array(ck[same]), pa.array(sets.size[same].astype(np.int64)), pa.array(toks, pa.binary())], ["ck", "n", "toks"])

    return run


def _read_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes and sizes of each set of a batch, and all tokens."""
    size = batch.column(1).to_numpy()
    return batch.column(0).to_numpy(), size, np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)


def _count_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tok, count = np.unique(_read_sets(batch)[2], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(count.astype(np.int64))], ["token", "n"])


def _entries_whole(percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in batches:
            ck, size, tok = _read_sets(batch)
            row = np.repeat(np.arange(len(ck)), size)
            is_often = np.isin(tok, often) if len(often) else np.zeros(len(tok), bool)
            rare = ~is_often
            yield _rows(0, tok[rare].view(np.int64), ck[row[rare]], size[row[rare]])
            yield _rows(3, ck[row[is_often]], tok[is_often].view(np.int64), size[row[is_often]])

    return run


def _inside(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("ck").sort_values("ck")
        ck = pdf["ck"].to_numpy()
        label, degree = link_block([np.frombuffer(x, np.uint64) for x in pdf["toks"]], ck, percent)
        return pd.DataFrame({"comp": pdf["comp"].to_numpy(), "block": pdf["block"].to_numpy(), "ck": ck, "label": label, "degree": degree})

    return run


def _across(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ck", "probe"], ascending=[True, False]).drop_duplicates("ck")
        label = pdf["label"].to_numpy()
        got, _ = link_block([np.frombuffer(x, np.uint64) for x in pdf["toks"]], label, percent, pdf["probe"].to_numpy())
        edge = pd.DataFrame({"a": label, "b": got})
        return edge[edge["a"] != edge["b"]].drop_duplicates()

    return run


def _small(table: DataFrame) -> DataFrame:
    """A table to be broadcast if it is counted to be small; beyond, Spark shuffles it and splits hot keys."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _by_key(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of values (a row for each key; `rows`: how many rows have it).

    Keys of very many rows, of which there are HOT_CLASSES at most, meet them by broadcast.
    """
    total = values.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(values.where(F.col("rows") > max(HOT_ROWS, total // HOT_CLASSES)).drop("rows"))
    cold = rows.join(hot, keys, "left_anti").join(values.drop("rows"), keys)
    return rows.join(hot, keys).unionByName(cold)


def _relabel(table: DataFrame, edges: DataFrame) -> DataFrame:
    roots = _small(components(edges))
    out = table.join(roots, table["label"] == roots["node"], "left").withColumn("label", F.coalesce("root", "label"))
    return materialize(out.drop("node", "root"), "labels")


def _cross(sets: DataFrame, probes: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Label edges from comparing every set of a part with the part's probes, block by block.

    probes: comp, chunk, and the columns of sets.  Each (part, chunk, block) is a task's group.
    """
    blocks = _small(sets.select("comp", "block").distinct())
    chunks = _small(probes.select("comp", "chunk").distinct())
    cols = ["comp", "chunk", "block", "ck", "label", "toks", "probe"]
    base = sets.join(chunks, "comp").withColumn("probe", F.lit(False)).select(cols)
    ask = probes.drop("block").join(blocks, "comp").withColumn("probe", F.lit(True)).select(cols)
    both = base.unionByName(ask).repartition(tasks, "comp", "chunk", "block")
    return both.groupBy("comp", "chunk", "block").applyInPandas(_across(percent), "a long, b long")


def _frequent(counted: DataFrame, least: int, name: str):
    """Tokens of (token, n) in over `least` and over T / FREQUENT_MOST places, T being all places: FREQUENT_MOST at most.

    Returns them as a sorted broadcast array, and T.
    """
    counted = counted.groupBy("token").agg(F.sum("n").alias("n"))
    many = materialize(counted.select(F.when(F.col("n") > least, F.col("token")).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n")), name)
    total = many.agg(F.sum("n")).first()[0] or 0
    often = many.where(F.col("token").isNotNull() & (F.col("n") > max(least, total // FREQUENT_MOST))).select("token").toPandas()
    return counted.sparkSession.sparkContext.broadcast(np.sort(often["token"].to_numpy(np.int64).view(np.uint64))), total


def _ties(shared: DataFrame, index, tasks: int) -> DataFrame:
    """Edges (a, b) between classes from rows of kinds 1 and 3."""
    shared = shared.distinct().repartition(tasks, "a").sortWithinPartitions("a", "kind", "d", "b")
    keys = shared.mapInArrow(index, _ROWS).repartition(tasks, "a").sortWithinPartitions("kind", "a", "b")
    return keys.mapInArrow(_meet, _ROWS).select("a", "b")


def _refined(sets: DataFrame, percent: int, frequent_least: int) -> DataFrame:
    """(ck, comp) of the classes that may still link: ties over whole sets, rarest tokens first."""
    frequent, total = _frequent(sets.mapInArrow(_count_whole, "token long, n long"), frequent_least, "in-play-counts")
    found = sets.mapInArrow(_entries_whole(percent, frequent), _ROWS)
    tasks = tasks_for(sets.sparkSession, total, 2_000_000)
    found = found.repartition(tasks, "a").sortWithinPartitions("kind", "a", "b").mapInArrow(_shared, _ROWS)
    return components(_ties(found, _index(percent, whole=True), tasks)).toDF("ck", "comp")


def _verified(sets: DataFrame, parts: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """(ck, label): sets (ck, n, toks) whose labels are equal are those that links connect."""
    spark = sets.sparkSession
    play = materialize(sets.select("ck", "n").distinct().join(parts, "ck"), "in-parts")
    sums = play.groupBy("comp").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    whole, live = play.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bins = max(1, 2 * whole // block_tokens, 2 * live // BLOCK_ROWS)
    n_blocks = F.greatest(F.ceil(F.col("tokens") / F.lit(block_tokens)), F.ceil(F.col("rows") / F.lit(BLOCK_ROWS))).cast("long")
    split = _small(materialize(sums.select("comp", n_blocks.alias("blocks")).where("blocks > 1"), "split"))
    block = F.pmod(F.xxhash64("ck"), F.col("blocks"))
    put = play.join(split, "comp", "left").select(
        "ck",
        "comp",
        F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("comp"), F.lit(bins))).otherwise(F.xxhash64("comp", block)).alias("bin"),
        F.coalesce(block, F.lit(-1)).cast("long").alias("block"),
    )
    placed = materialize(sets.join(put, "ck").select("bin", "comp", "block", "ck", "n", "toks"), "placed")
    tasks = tasks_for(spark, bins, 1)
    labels = placed.repartition(tasks, "bin").groupBy("bin").applyInPandas(_inside(percent), "comp long, block long, ck long, label long, degree long")
    labels = materialize(labels, "labels")

    split = labels.where("block >= 0")
    if not split.isEmpty():
        # Tie the blocks of a split part together: the best linked sets of some blocks are compared with all sets.
        best = split.groupBy("comp", "block").agg(F.max(F.struct("degree", "ck")).alias("best"))
        order = Window.partitionBy("comp").orderBy(F.desc("best"))
        hubs = best.withColumn("i", F.row_number().over(order)).where(F.col("i") <= HUBS).select(F.col("best.ck").alias("ck"))
        big = placed.where("block >= 0").select("comp", "block", "ck", "n", "toks")
        now = big.join(split.select("ck", "label"), "ck")
        probes = now.join(hubs, "ck", "left_semi").withColumn("chunk", F.lit(0).cast("long"))
        labels = _relabel(labels, _cross(now, probes, percent, tasks))
        # What is not in the largest piece by now is compared with everything else of its part, in larger blocks.
        now = big.withColumn("block", F.floor(F.col("block") / JOINED_BLOCKS)).join(labels.select("ck", "label"), "ck")
        pieces = now.groupBy("comp", "label").agg(F.sum("n").alias("tokens"))
        largest = _small(materialize(pieces.groupBy("comp").agg(F.max_by("label", F.struct("tokens", "label")).alias("largest")), "largest"))
        rest = now.join(largest, "comp").where(F.col("label") != F.col("largest")).drop("largest")
        left = _small(materialize(rest.groupBy("comp").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows")), "rest"))
        chunks = F.greatest(F.ceil(F.col("tokens") / F.lit(block_tokens * JOINED_BLOCKS)), F.ceil(F.col("rows") / F.lit(BLOCK_ROWS * JOINED_BLOCKS))).cast("long")
        rest = rest.join(left, "comp").withColumn("chunk", F.pmod(F.xxhash64("ck", F.lit(1)), chunks))
        labels = _relabel(labels, _cross(now, rest.select("comp", "block", "ck", "n", "toks", "label", "chunk"), percent, tasks))
    return labels.select("ck", "label")


def link_classes(docs: DataFrame, n: int = 5, percent: int = 80, block_tokens: int = 1 << 18, frequent_least: int = FREQUENT_LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id.

    class_id tells equal sets apart; component_id is the smallest doc_id that
    links reach.  A link: 100 * intersection >= percent * union.
    """
    spark = docs.sparkSession
    if not 50 <= percent <= 100 or n < 1:
        raise ValueError("percent must be 50 to 100 and n at least 1")
    name = F.col(f"`{doc_id}`").cast("long")
    docs = docs.select(F.coalesce(name, F.xxhash64(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"), name.isNull().alias("unnamed"))

    frequent, total = _frequent(docs.select("text").mapInArrow(_count_tokens(n, percent), "token long, n long"), frequent_least, "token-counts")
    found = docs.mapInArrow(_entries(n, percent, frequent), _ROWS)
    tasks = tasks_for(spark, total, 2_000_000)
    found = found.repartition(tasks, "a").sortWithinPartitions("kind", "a", "b")
    found = materialize(found.mapInArrow(_shared, _ROWS), "shared")
    rows = found.where("kind in (2, 4)").select(F.when(F.col("kind") == 2, F.col("d")).alias("doc_id"), F.col("d").alias("key"), F.col("c").alias("n"), F.col("a").alias("ck"), F.col("b").alias("ck2"))
    shared = found.where("kind in (1, 3)")
    # Partners meet in every task that has one of their keys: no more tasks than these fewer rows need.
    edges = _ties(shared, _index(percent), tasks_for(spark, shared.count(), 2_000_000))

    in_play = components(edges).select(F.col("node").alias("ck"))
    same = ("ck", "ck2", "n")
    classes = rows.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count("*").alias("rows"))
    classes = materialize(classes.withColumn("unnamed", F.col("doc_id").isNull()), "classes")
    # Any row of a class brings its set: that of its least doc_id, or of its text's hash if all are null.
    play = materialize(classes.join(in_play, "ck").select(F.when(F.col("unnamed"), F.col("key")).otherwise(F.col("doc_id")).alias("key"), "unnamed", "ck"), "in-play")
    if play.count() <= BROADCAST_ROWS:
        play = F.broadcast(play)
    sets = materialize(docs.join(play, ["key", "unnamed"]).select("text", "ck").mapInArrow(_full_sets(n), _SET_SCHEMA), "sets")
    labels = _verified(sets, _refined(sets, percent, frequent_least), percent, block_tokens)

    linked = classes.join(labels, "ck")
    least = materialize(linked.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")), "least")
    linked = _by_key(linked.withColumnRenamed("rows", "held"), least, ["label"]).select(*same, "component_id", F.col("held").alias("rows"))
    single = classes.join(labels, "ck", "left_anti").select(*same, F.col("doc_id").alias("component_id"), "rows")
    named = materialize(single.unionByName(linked), "components")
    result = ["doc_id", F.col("n").alias("n_shingles"), F.col("ck").alias("class_id"), "component_id"]
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id")).select(*result)
    return empty.unionByName(_by_key(rows.where("n > 0"), named, list(same)).select(*result))


#: DuckDB SQL for the query's columns over documents.
NGRAM_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
  FROM d
), t AS (SELECT doc_id, unnest(g) AS x FROM s),
c AS (SELECT md5(array_to_string(list_sort(g), chr(10))) AS k, min(doc_id) AS rep, len(any_value(g)) AS n FROM s WHERE len(g) > 0 GROUP BY k),
u AS (SELECT rep, n, x FROM c JOIN t ON t.doc_id = c.rep),
o AS (
  SELECT a.rep AS p, b.rep AS q, count(*) AS inter, any_value(a.n) AS pn, any_value(b.n) AS qn
  FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.rep, b.rep
), l AS (
  SELECT p, q FROM o WHERE 100 * inter >= 85 * (pn + qn - inter)
), e AS (SELECT p, q FROM l UNION SELECT q, p FROM l),
r AS (SELECT rep AS node, rep AS root FROM c UNION SELECT e.q, r.root FROM r JOIN e ON e.p = r.node),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON len(s.g) > 0 AND md5(array_to_string(list_sort(s.g), chr(10))) = c.k LEFT JOIN m ON m.node = c.rep
"""
