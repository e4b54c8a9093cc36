"""Best-fit packing with swap-based local search.

Texts become token ids (one id of the end mark after each); only documents longer than a sequence
are cut, into whole sequences and a rest. Pieces are dealt over shards of about `shard` pieces by a
hash; a shard packs its pieces best-fit in decreasing order and then improves the packing: pieces
are moved, exchanged one for one, or two for one between underfull bins whenever that raises the sum
of squared fills, so that full bins fill up and the emptiest ones run out, until no step is left or the
bins are as few as the lengths allow. Each shard gives the pieces of its emptiest bin, if that is not
full, to the next round, which packs those of all shards in the same way; the rounds shrink by the
pieces of a shard over those of a bin, and end with one shard.

Only lengths travel to a shard, never texts or ids.

Defined cases: a null or empty text is one piece of the end mark; a text of exactly a multiple of
the sequence length has full pieces only; equal documents are packed each; rows with equal or null
ids are told apart by nothing and are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

END = b"\x01\x00\x00\x00"


class TextIds:
    """Token ids of whole texts, as little-endian bytes.

    For a lower-casing byte-pair vocabulary with word ends (the vocabulary of the packing queries)
    the merges become the ranks of a faster encoder: a word's end is the byte 0, which no vocabulary
    entry holds, so a token that ends a word is its bytes and a 0, and ranks are in merge order. Texts
    with a NUL, a special token's opening or a capital sigma (whose lower case depends on its
    neighbours in Python only) and all other vocabularies take the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"] and spec["model"].get("end_of_word_suffix") == "</w>":
            import regex
            import tiktoken

            ranks, self.ids = self._ranks(spec["model"])
            # white space as Unicode has it; Python's \\s also takes the separators 1C to 1F
            pattern = steps[0]["pattern"]["Regex"].replace(r"\s", r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
            self.words = regex.compile(pattern).findall
            # the same over lower-cased ASCII, where letters and digits are short classes
            self.ascii_words = re.compile(pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}\p{N}", "a-z0-9")).findall
            self.fast = tiktoken.Encoding("word-ends", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _ranks(model: dict) -> tuple[dict[bytes, int], np.ndarray]:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

        def raw(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(byte[c] for c in (token[:-4] if end else token)) + b"\0" * end

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(1, 256)}
        for i, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks.setdefault(raw(left) + raw(right), 512 + i)
        ids = np.zeros(max(ranks.values()) + 1, "<u4")
        for token, i in model["vocab"].items():
            if not token.startswith("<|") and (k := raw(token)) in ranks:
                ids[ranks[k]] = i
        return ranks, ids

    def __call__(self, text: str) -> bytes:
        if self.fast is None or "\0" in text or "<|" in text or "Σ" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = self.ascii_words(text.lower()) if text.isascii() else self.words(unicodedata.normalize("NFC", text).lower())
        return self.ids[self.fast.encode_to_numpy("\0".join(words) + "\0", disallowed_special=())].tobytes() if words else b""


@lru_cache(2)
def text_ids(path: str) -> TextIds:
    """One encoder for all tasks of a worker."""
    return TextIds(path)


def pieces(docs: DataFrame, tokenizer: str, cap: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32 of every document's pieces."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(tokenizer)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + END
                for piece, start in enumerate(range(0, len(ids) // 4, cap)):
                    part = ids[4 * start : 4 * (start + cap)]
                    at.append(i)
                    rows.append((piece, start, len(part) // 4, zlib.crc32(part)))
            cols = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0].astype(np.int32)), *(pa.array(c) for c in cols[1:])], names=["id", "piece", "start", "length", "ids_crc32"]
            )

    return src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Bins (lists of places) by best fit in decreasing order."""
    by_room: list[list[int]] = [[] for _ in range(cap + 1)]
    rooms, bins = 0, []  # rooms: bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = cap, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Moves, 1-1 and 2-1 exchanges from emptier bins to fuller ones, each the one that raises the sum of squared fills most.

    Sweeps take each underfull bin once as the giving one, the emptiest first, against all fuller
    underfull bins, and go on until a whole sweep finds no step: a local optimum. They end before it
    only when the bins are as few as the total length allows. Every step raises the sum of squares, so
    the search ends.
    """
    bins = [list(b) for b in bins]
    size = np.asarray(lengths, np.int64)
    fill = np.array([int(size[b].sum()) for b in bins], np.int64)
    fewest = -(-int(size.sum()) // cap)
    live = int((fill > 0).sum())
    changed = True
    while changed and live > fewest:
        changed = False
        for giver in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[giver] < cap and live > fewest:
                step = _best_step(giver, bins, size, fill, cap)
                if step is None:
                    break
                taker, given, back = step
                gain = int(size[list(given)].sum()) - (int(size[back]) if back is not None else 0)
                for i in given:
                    bins[giver].remove(i)
                bins[taker].extend(given)
                if back is not None:
                    bins[taker].remove(back)
                    bins[giver].append(back)
                fill[taker] += gain
                fill[giver] -= gain
                changed = True
                live -= not bins[giver]
    return [b for b in bins if b]


def _best_step(giver: int, bins: list[list[int]], size: np.ndarray, fill: np.ndarray, cap: int) -> tuple[int, tuple[int, ...], int | None] | None:
    """(taking bin, pieces given, piece taken back) of the step that raises the sum of squared fills most; None if no step raises it."""
    takers = np.flatnonzero((fill >= fill[giver]) & (fill < cap))
    takers = takers[takers != giver]
    if not len(takers):
        return None
    counts = np.array([len(bins[t]) for t in takers])
    # what may come back: nothing (a move), or a piece of the taking bin
    back = np.concatenate([np.full(len(takers), -1), np.concatenate([bins[t] for t in takers]).astype(np.int64)])
    taker = np.concatenate([takers, np.repeat(takers, counts)])
    returned = np.where(back >= 0, size[back], 0)
    room = cap - fill[taker] + returned
    mine = np.array(bins[giver])
    mine = mine[np.argsort(size[mine], kind="stable")]
    best: tuple[int, int, tuple[int, ...]] | None = None
    left, right = np.triu_indices(len(mine), 1)
    pairs = size[mine[left]] + size[mine[right]]
    order = np.argsort(pairs, kind="stable")
    for sums, given in ((size[mine], lambda k: (int(mine[k]),)), (pairs[order], lambda k: (int(mine[left[order[k]]]), int(mine[right[order[k]]])))):
        if not len(sums):
            continue
        at = np.searchsorted(sums, room, "right") - 1
        gain = np.where(at >= 0, sums[np.maximum(at, 0)] - returned, 0)
        raised = np.where(gain > 0, gain * (fill[taker] - fill[giver] + gain), 0)
        k = int(raised.argmax())
        if raised[k] > 0 and (best is None or raised[k] > best[0]):
            best = (int(raised[k]), k, given(int(at[k])))
    return None if best is None else (int(taker[best[1]]), best[2], int(back[best[1]]) if back[best[1]] >= 0 else None)


def pack_shard(lengths: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece, and the number of bins."""
    whole = np.flatnonzero(lengths >= cap)
    rest = np.flatnonzero(lengths < cap)
    bins = [[int(i)] for i in whole]
    bins += [[int(rest[i]) for i in b] for b in improve(best_fit(lengths[rest], cap), lengths[rest], cap)]
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(bins):
        at = 0
        for i in items:
            where[i], offset[i] = b, at
            at += int(lengths[i])
    return where, offset, len(bins)


def pack(docs: DataFrame, tokenizer: str, cap: int = 4096, shard: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    left = written(pieces(docs, tokenizer, cap, id_col, text_col))
    kind = left.schema["id"].dataType.simpleString()
    columns = ["id", "piece", "start", "length", "ids_crc32"]
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
    out, level, shards = None, 0, 0

    def packer(level: int, many: bool):
        def run(table: pa.Table) -> pa.Table:
            n, shard_id = table["length"].to_numpy(), table["shard"][0].as_py()
            where, offset, bins = pack_shard(n, cap)
            fill = np.bincount(where, n, bins)
            emptiest = where == fill.argmin() if many and fill.min() < cap else np.zeros(len(n), bool)
            cols = [(level << 58) + (shard_id << 20) + where, offset, emptiest]
            return pa.Table.from_arrays([*(table[c] for c in columns), *map(pa.array, cols)], names=[*columns, "sequence_id", "offset", "open"])

        return run

    while True:
        before, shards = shards, max(1, -(-left.count() // shard))
        # rows are dealt by their place in the written table, so that repeated rows spread like others;
        # a stated number of partitions, a few shards each, is not coalesced to one by its few bytes
        dealt = left.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))).repartition(-(-shards // 4), "shard")
        packed = dealt.groupBy("shard").applyInArrow(packer(level, shards > 1), schema)
        if shards == 1 or shards == before:  # one shard, or bins of so many pieces that merging shards gains nothing
            out = packed if out is None else out.unionByName(packed)
            return out.drop("open").withColumnRenamed("id", id_col)
        packed = written(packed)
        done = packed.filter("NOT open")
        out = done if out is None else out.unionByName(done)
        left = written(packed.filter("open").select(*columns))
        level += 1
