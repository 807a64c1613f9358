"""Runs: maximal periodic stretches of words, by a suffix automaton with link-cut access.

The automaton of a word sequence is built word by word. Its suffix links form a tree in which the path
from the root to the newest state stands for all suffixes of what was read, and every part of that path
carries the position where those suffixes last ended. An appended word recolours the whole path to its
own position; the parts met on the way are what link-cut trees call preferred paths, so there are
O(log n) of them per word, amortised, however deep the tree is. A part whose suffixes reach ``length``
words and last ended ``d`` words ago, ``d <= length``, is a square of period ``d``: the suffix overlaps
or touches its earlier self. Since ``d`` is the distance to the nearest earlier end, it is the least
period, and since longer suffixes ended elsewhere, the stretch reaches as far left as it can. It is
extended to the right once; later words inside it meet it again and pass by.

Only words that can lie in a run are given to the automaton. A run of ``MIN_LENGTH`` words and two
periods consists of words that lie in a sequence of ``MIN_LENGTH // 2`` words found twice in the run.
So words are marked where such a sequence occurs twice in the document, unmarked ones part it into
stretches, and the same is asked of each stretch until nothing changes. A run never reaches over the
edge of a stretch, so each stretch stands alone. The marks compare hashes of words: a collision costs
time and loses nothing; the automaton compares words.

Defined results
---------------
* words are what stands between white space (space, tab to carriage return); a null or blank text has none
* every row is judged alone, so null, repeated or clashing ids and repeated rows change nothing
* a very long text is worked on whole, by one task, in memory proportional to its own length
* other columns are not read; an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import text_of

MIN_LENGTH = 12
#: text worked on at a time, unless one text alone is longer
CHUNK_BYTES = 2 << 20

_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
OUT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_KIND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def squares(words: Sequence) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)``, end exclusive, of at least two periods, in order of discovery.

    ``splay_up``, ``left`` and ``right`` hold one splay tree per preferred path, deeper states to the
    right; the parent of a tree's root is the state above the path. A path has one colour, at its root.
    """
    n = len(words)
    moves: list[dict] = [{}]
    link, depth = [-1], [0]
    left, right, splay_up, colour = [-1], [-1], [-1], [-1]
    known: dict[int, int] = {}  # period: where its newest run ends
    runs: list[tuple[int, int, int]] = []

    def splay(x: int) -> None:
        while True:
            p = splay_up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = splay_up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                if (left[g] == p) == (left[p] == x):
                    turn(p, g)
                    turn(x, p)
                else:
                    turn(x, p)
                    turn(x, g)
            else:
                turn(x, p)

    def turn(x: int, p: int) -> None:
        g = splay_up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            splay_up[inner] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        splay_up[x], splay_up[p] = g, x
        colour[x] = colour[p]

    def state(length: int, link_to: int, edges: dict) -> int:
        moves.append(edges)
        link.append(link_to)
        depth.append(length)
        for part in (left, right, splay_up, colour):
            part.append(-1)
        return len(depth) - 1

    last = 0
    for i, word in enumerate(words):
        new = state(i + 1, 0, {})
        p = last
        while p >= 0 and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p >= 0:
            q = moves[p][word]
            if depth[q] > depth[p] + 1:
                # the shorter strings of q get a state of their own between q and its parent, on q's path
                clone = state(depth[p] + 1, link[q], dict(moves[q]))
                while p >= 0 and moves[p].get(word) == q:
                    moves[p][word] = clone
                    p = link[p]
                splay(q)
                above = left[q]
                left[clone] = above
                if above >= 0:
                    splay_up[above] = clone
                left[q], splay_up[clone] = clone, q
                link[q] = clone
                q = clone
            link[new] = q
        splay_up[new] = link[new]
        last = new
        # access: every path met is a set of suffixes with one last end
        v, deeper = new, -1
        while v >= 0:
            splay(v)
            below = right[v]
            if below >= 0:
                colour[below] = colour[v]
            right[v] = deeper
            ended, reach = colour[v], depth[v]
            period = i - ended
            if ended >= 0 and period <= reach and known.get(period, -1) <= i:
                end = i + 1
                while end < n and words[end] == words[end - period]:
                    end += 1
                known[period] = end
                runs.append((i + 1 - reach - period, end, period))
            deeper, v = v, splay_up[v]
        splay(new)
        colour[new] = i
    return runs


def stretches(hashes: np.ndarray, owner: np.ndarray, need: int) -> list[tuple[int, int]]:
    """``(from, to)`` of the stretches that can hold runs; ``owner`` says to which text a word belongs."""
    place = np.arange(len(hashes))
    while len(place) >= 2 * need:
        gram = np.zeros(len(place) - need + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(need):
                gram = gram * np.uint64(_ODD[0]) + hashes[place[k : k + len(gram)]]
            gram ^= gram >> np.uint64(29)
            gram += owner[: len(gram)].astype(np.uint64) * np.uint64(_ODD[1])
        whole = np.flatnonzero(owner[: len(gram)] == owner[need - 1 :])
        order = np.argsort(gram[whole])
        ordered = gram[whole][order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(whole), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(place) + 1, np.int64)
        cover[whole[twice]] += 1
        cover[whole[twice] + need] -= 1
        kept = np.cumsum(cover[:-1]) > 0
        edge = kept & np.append(True, (~kept[:-1]) | (owner[1:] != owner[:-1]))
        number = np.cumsum(edge)
        size = np.bincount(number[kept], minlength=number[-1] + 1)
        kept &= size[number] >= 2 * need
        if kept.all():
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(starts, np.append(starts[1:], len(place)))]
        place, owner = place[kept], number[kept]
    return []


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each text, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    counts = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(counts) - counts
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, int(counts.sum())).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    for a, b in stretches(hashes, owner, max(1, min_length // 2)):
        text = int(owner[a])
        words, shift = texts[text][a - begin[text] : b - begin[text]], a - int(begin[text])
        numbers: dict[bytes, int] = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in words]
        found[text] += [(s + shift, e - s, q) for s, e, q in squares(ids) if e - s >= min_length]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: the runs of every text, and the text with each reduced to its first period."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_buffer()
                ids.append(doc.as_py())
                texts.append(raw.to_pybytes().split())
                size += raw.size
                if size >= CHUNK_BYTES:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks(batches):
            runs = runs_of(texts, min_length)
            columns = [ids, [len(t) for t in texts], [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs],
                       [b" ".join(collapse(t, r)).decode() for t, r in zip(texts, runs)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KIND)], schema=_KIND)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(work, OUT)
