"""Best-fit packing of token sequences, improved by exchanges between underfull bins.

Documents become token ids and are cut into pieces of at most one sequence. The
pieces are dealt by hash into groups of bounded size, each of which a task packs
by best fit, longest first. Then bins that are not full exchange pieces: the
emptiest one gives one or two pieces to another bin, against nothing, one or two
smaller ones, whenever that raises the sum of squared fills. The sum can only
grow, so the search ends, and what it does is to fill the full bins up and to
empty the others. Bins still underfull go to other groups, whole, and are
searched there again, those with the most room longest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, worker_memo
from corpusloom.session import cut_lineage

#: Tokens of a sequence, and pieces of a group that one task packs at once.
CAPACITY, GROUP = 2048, 4096

#: Entries of each generation of what a worker remembers, and the longest text remembered.
MEMO_ENTRIES, MEMO_CHARS = 400_000, 48

#: Control characters at which str.split parts a text and the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"

#: Texts of characters whose lower case is the same in any place and that are already in normal form C.
_PLAIN = re.compile("[\t-\r -~À-ÿ]*")

#: The tokenizer's own pattern, and what it finds in lower-case texts of these characters besides runs of letters.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_OTHER_PARTS = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+)"

#: Texts that a task takes apart at once.
SLICE = 2048

_PIECE = "piece: int, start: long, length: long, ids_crc32: long"


class Memo:
    """What was looked up lately: two generations of bounded size, of which the older one is dropped."""

    def __init__(self, entries: int) -> None:
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(key) > MEMO_CHARS:
            return
        if len(self.young) >= self.entries:
            self.old = self.young.copy()
            self.young.clear()
        self.young[key] = value


class TextEncoder:
    """Ids of whole texts from ``tokenizers``, as little-endian unsigned 32-bit numbers, remembered by parts.

    Texts of plain characters are taken apart here as the tokenizer's pattern says,
    and only parts that are new go to its model. Other texts, and those with a
    special token's name, are cut at white space, which no token reaches over, and
    their new chunks go to the tokenizer whole, as do all chunks of a tokenizer with
    another pattern.
    """

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(content)
        made = json.loads(content)
        self._names = [t["content"] for t in made["added_tokens"]]
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        self._known = [p.get("pattern", {}).get("Regex") for p in steps[:1]] == [_PATTERN]
        self._chunks, self._parts = Memo(MEMO_ENTRIES // 4), Memo(MEMO_ENTRIES)
        self._model = self._tokenizer.model
        written = self._tokenizer.pre_tokenizer.pre_tokenize_str
        #: How the tokenizer writes characters to its model.
        self._written = {c: written(chr(c))[0][0] for c in (*range(33, 127), *range(0xC0, 0x100))} if self._known else {}

    def _library(self, text: str) -> bytes:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            ids = [t.id for t in self._model.tokenize(part if part.isalpha() and part.isascii() else part.translate(self._written))]
            found = struct.pack(f"<{len(ids)}I", *ids)
            self._parts.put(part, found)
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self._chunks.get(chunk)
        if found is None:
            found = self._library(chunk)
            self._chunks.put(chunk, found)
        return found

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Each different part of the texts is looked up once; their ids are put together from the parts' numbers."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(pa.array(texts, pa.string())), pattern=_OTHER_PARTS, replacement=r" \1 ")
        parts = pc.ascii_split_whitespace(spaced)
        coded = parts.flatten().dictionary_encode()
        found = [self._part(p) for p in coded.dictionary.to_pylist()]
        table = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.array([len(f) for f in found], dtype=np.int64) // 4
        starts, of = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[of])])
        ids = table[np.repeat(starts[of] - ends[:-1], sizes[of]) + np.arange(ends[-1])]
        cuts = ends[parts.offsets.to_numpy()]
        return [ids[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self._known and bool(_PLAIN.fullmatch(t)) and not any(n in t for n in self._names) for t in texts]
        simple = [t for t, p in zip(texts, plain) if p]
        out = iter(self._plain(simple) if simple else [])
        return [next(out) if p else self._other(t) for t, p in zip(texts, plain)]

    def _other(self, text: str) -> bytes:
        if any(c in text for c in _SEPARATORS):
            return self._library(text)
        return b"".join([self._chunk(c) for c in text.split()])


def token_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: every text's ids and a final 0, cut into pieces of ``capacity`` at most.

    ``tokenizer`` is the content of a tokenizer's file. A null text counts as
    empty: one piece, the final id alone. Null keys and repeated rows are kept as
    they are; other columns take no part, whatever their names. One narrow pass.
    """

    def make():
        memo = worker_memo("text_encoder")
        if hash(tokenizer) not in memo:
            memo[hash(tokenizer)] = TextEncoder(tokenizer)
        encoder = memo[hash(tokenizer)]

        def cut(ids: bytes) -> list[dict]:
            ids += bytes(4)
            ranges = range(0, len(ids), 4 * capacity)
            parts = [ids[at : at + 4 * capacity] for at in ranges]
            return [
                {"piece": i, "start": at // 4, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)}
                for i, (at, p) in enumerate(zip(ranges, parts))
            ]

        return lambda cols: {"key": cols["key"], "pieces": [cut(ids) for ids in encoder.encode(cols["text"])]}

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    cuts = map_rows(rows, make, f"key {kind}, pieces array<struct<{_PIECE}>>", SLICE)
    return cuts.select(F.col("key").alias(key), F.inline("pieces"))


def fewest(counts: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing of ``counts[n]`` pieces of each length n can go below.

    For a limit t, pieces longer than capacity - t share a bin with none that is t
    or longer, and those above half a bin not with each other; what the other
    pieces of t or more need beyond the room next to these is more bins.
    """
    tokens = counts * np.arange(capacity + 1)
    number, total = np.cumsum(counts[::-1])[::-1], np.cumsum(tokens[::-1])[::-1]
    best, half = -(-int(total[0]) // capacity), capacity // 2 + 1
    for t in range(1, half):
        alone, large = number[capacity - t + 1], number[half] - number[capacity - t + 1]
        room = large * capacity - (total[half] - total[capacity - t + 1])
        rest = total[t] - total[half]
        best = max(best, int(alone + large + max(0, -(-(rest - room) // capacity))))
    return best


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of positions: longest piece first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g is set if some bin has room for g
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = gaps >> lengths[i]
        if fitting:
            gap = (fitting & -fitting).bit_length() - 1 + lengths[i]
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
            bins[at].append(i)
        else:
            gap, at = capacity, len(bins)
            bins.append([i])
        left = gap - lengths[i]
        by_gap[left].append(at)
        gaps |= 1 << left
    return bins


class _Offers:
    """What a bin may give or take: nothing, one piece or two, one offer for each different sum."""

    def __init__(self, pieces: list[int], lengths: list[int]) -> None:
        one = {lengths[p]: (p,) for p in pieces}
        two = {lengths[p] + lengths[q]: (p, q) for p, q in combinations(self._spread(pieces, lengths), 2)}
        self.pieces = [(), *one.values(), *two.values()]
        self.sums = np.array([0, *one, *two], dtype=np.int64)
        self.kinds = np.repeat([0, 1, 2], [1, len(one), len(two)])

    @staticmethod
    def _spread(pieces: list[int], lengths: list[int]) -> list[int]:
        """At most two pieces of each length: no pair needs a third."""
        seen: dict[int, int] = {}
        kept = []
        for p in pieces:
            seen[lengths[p]] = seen.get(lengths[p], 0) + 1
            if seen[lengths[p]] <= 2:
                kept.append(p)
        return kept


def exchange(bins: list[list[int]], lengths: list[int], capacity: int, enough: int = 0) -> list[list[int]]:
    """Raise the sum of squared fills by moves and swaps of one or two pieces until none helps or ``enough`` bins are left."""
    bins = [list(b) for b in bins]
    fill = np.array([sum(lengths[p] for p in b) for b in bins], dtype=np.int64)
    left = len(bins)
    offers = {b: _Offers(bins[b], lengths) for b in np.flatnonzero(fill < capacity).tolist()}
    moved = True
    while moved and left > enough:
        moved = False
        for giver in sorted(offers, key=lambda b: (fill[b], b)):
            while giver in offers and left > enough:
                found = _best_exchange(giver, offers, fill, capacity)
                if found is None:
                    break
                taker, gives, gets = found
                moved = True
                for here, there, pieces in ((giver, taker, gives), (taker, giver, gets)):
                    for p in pieces:
                        bins[here].remove(p)
                        bins[there].append(p)
                for b in (giver, taker):
                    fill[b] = sum(lengths[p] for p in bins[b])
                    if 0 < fill[b] < capacity:
                        offers[b] = _Offers(bins[b], lengths)
                    else:
                        del offers[b]
                left -= fill[giver] == 0
    return [b for b in bins if b]


def _best_exchange(giver: int, offers: dict[int, _Offers], fill: np.ndarray, capacity: int):
    """(taker, pieces given, pieces got) of the largest gain, or None."""
    mine, others = offers[giver], [b for b in offers if b != giver]
    if not others:
        return None
    sums = np.concatenate([offers[b].sums for b in others])
    kinds = np.concatenate([offers[b].kinds for b in others])
    sizes = [len(offers[b].sums) for b in others]
    of = np.repeat(np.arange(len(others)), sizes)
    full = fill[others][of]
    best, found = 0, None
    for i in range(1, len(mine.sums)):
        more = mine.sums[i] - sums
        gain = 2 * more * (full - fill[giver] + more)
        gain[(more <= 0) | (more > capacity - full) | (kinds + mine.kinds[i] > 3)] = 0
        at = int(gain.argmax())
        if gain[at] > best:
            best, found = gain[at], (at, i)
    if found is None:
        return None
    at, i = found
    taker = others[of[at]]
    return taker, mine.pieces[i], offers[taker].pieces[at - sum(sizes[: of[at]])]


def pack_group(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """The better of the given packing and best fit, after exchanges."""
    enough = fewest(np.bincount(lengths, minlength=capacity + 1), capacity)
    anew = best_fit(lengths, capacity)
    return exchange(anew if len(anew) <= len(bins) else bins, lengths, capacity, enough)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id, offset``: a bin for each piece and its place there, without gaps from 0.

    ``pieces`` has a long column ``length`` from 1 to ``capacity``; its other columns
    are passed through (``sequence_id`` and ``offset`` are replaced, ``fill`` and
    ``own`` dropped). Groups hold about ``group`` pieces, by a hash of the bin they
    are in, so equal and repeated rows spread like others. The first round takes all
    pieces, each later one the bins with the most room, half as many pieces as the
    round before; a round keeps the bins it finds none better for. The last round
    is one group, or there are no fewer bins to be had. Two histograms over lengths
    and fills, of ``capacity`` numbers, come to the driver. An empty table gives no
    rows.
    """
    given = pieces.drop("sequence_id", "offset", "fill", "own")
    own = given.withColumn("own", F.monotonically_increasing_id()).withColumn("sequence_id", F.col("own"))
    state = cut_lineage(own.withColumns({"offset": F.lit(0).cast("long"), "fill": F.col("length")}))
    schema = state.schema
    enough = fewest(_histogram(state, "length", capacity), capacity)
    done, bins, limit = [], 0, capacity
    while True:
        done.append(state.where(F.col("fill") >= limit))
        bins += done[-1].where("offset = 0").count()
        rows = int(_histogram(state, "fill", capacity)[:limit].sum())
        if not rows:
            break
        groups = -(-rows // group)
        name = F.pmod(F.xxhash64("sequence_id", F.lit(len(done))), F.lit(groups))
        chosen = state.where(F.col("fill") < limit).withColumn("_group", name)
        state = cut_lineage(chosen.groupBy("_group").applyInPandas(_pack_rows(capacity), schema))
        ahead = np.cumsum(_histogram(state, "fill", capacity))  # rows in bins of up to this fill
        limit = min(capacity, int(np.searchsorted(ahead, rows // 2, side="right")))
        if groups == 1 or bins + state.where("offset = 0").count() <= enough:
            done.append(state)
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("fill", "own")


def _histogram(rows: DataFrame, column: str, capacity: int) -> np.ndarray:
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for value, n in rows.groupBy(column).count().collect():
        counts[value] = n
    return counts


def _pack_rows(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_group").reset_index(drop=True)
        lengths = rows["length"].tolist()
        own = rows["own"].to_numpy()
        before = list(rows.groupby("sequence_id").indices.values())
        offset, fill, name = (np.zeros(len(rows), dtype=np.int64) for _ in range(3))
        for b in pack_group(lengths, [x.tolist() for x in before], capacity):
            size = np.asarray([lengths[p] for p in b], dtype=np.int64)
            ends = np.cumsum(size)
            offset[b], fill[b], name[b] = ends - size, ends[-1], own[b].min()  # a bin is named by its first piece
        return rows.assign(sequence_id=name, offset=offset, fill=fill)

    return run


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts with their sequences: ``key, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(token_pieces(docs, tokenizer, key, text, capacity), capacity)
