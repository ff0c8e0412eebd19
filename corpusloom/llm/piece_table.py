"""SentencePiece (merge type) encoding by a prefix table, and decoding.

For each prefix of a normalised text the table holds the one token that its
encoding ends with. Candidates for a prefix are the vocabulary entries that an
Aho-Corasick automaton finds ending there; the right one is the candidate that
may follow the last token of the prefix in front of it, which is a test on the
two tokens alone: merging their concatenation must give back just these two.
The ids are then recovered from the end of the table to its start.

Texts are cut before each run of spaces that follows another character. No
vocabulary entry reaches over such a place (checked when the model is loaded),
so no merge can, and the pieces of a text are encoded independently and
remembered by the worker.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, worker_memo

SPACE = "▁"
#: Bounds of what a worker remembers, which change no result. Words are kept in two generations of half as many:
#: when the younger is full it replaces the older, so words met again and again stay. Pairs start anew.
MEMO_WORDS, MEMO_PAIRS, MEMO_CHARS = 400_000, 1_000_000, 48


class PieceTable:
    """Encoder and decoder of one merge-type SentencePiece model."""

    def __init__(self, model: bytes, memo_words: int = MEMO_WORDS) -> None:
        import ahocorasick
        import sentencepiece

        self._sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        self._ids = {sp.id_to_piece(i): i for i in range(size) if not special[i]}
        self._score = {p: sp.get_score(i) for p, i in self._ids.items()}
        self._bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self._unknown = sp.unk_id()
        #: For each entry the tokens met in front of it, and whether it may follow them.
        self._follows: dict[str, dict[str, bool]] = {}
        self._known_pairs = 0
        self._automaton = ahocorasick.Automaton()
        for p in self._ids:
            self._automaton.add_word(p, (p, len(p), self._follows.setdefault(p, {})))
        self._automaton.make_automaton()
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self._ids)
        self._cut = re.compile("(?s).+" if crossing else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._generation = memo_words // 2
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _merge(self, text: str) -> list[str]:
        """Merge adjacent symbols, best score first and leftmost among equals, until none is left."""
        parts, score = list(text), self._score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: str, right: str) -> bool:
        if self._known_pairs >= MEMO_PAIRS:
            self._known_pairs = 0
            for known in self._follows.values():
                known.clear()
        self._known_pairs += 1
        fits = self._follows[right][left] = self._merge(left + right) == ([left, right] if left else [right])
        return fits

    def _table(self, text: str) -> list[str]:
        """The last token of every prefix of ``text``; entry 0 is the empty prefix."""
        last = [""] * (len(text) + 1)
        for end, (piece, size, known) in self._automaton.iter(text):  # at each end the longest match comes first
            end += 1
            if not last[end]:
                before = last[end - size] or text[end - size - 1 : end - size]
                fits = known.get(before)
                if self._compatible(before, piece) if fits is None else fits:
                    last[end] = piece
        return last

    def _backwards(self, text: str) -> tuple[int, ...]:
        last, at, ids = self._table(text), len(text), []
        while at:
            piece = last[at] or text[at - 1]  # a character outside the vocabulary ends this prefix
            known = self._ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self._bytes:
                ids.extend(self._bytes[b] for b in reversed(piece.encode()))
            else:
                ids.append(self._unknown)
            at -= len(piece)
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        words, out = self._words, []
        for word in self._cut.findall(self._sp.normalize(text)):
            ids = words.get(word)
            if ids is None:
                ids = self._older.get(word) or self._backwards(word)
                if len(word) <= MEMO_CHARS:
                    if len(words) >= self._generation:
                        self._older, words = words, {}
                        self._words = words
                    words[word] = ids
            out.append(ids)
        return list(chain.from_iterable(out))

    def decode(self, ids: list[int]) -> str:
        return self._sp.decode(ids)


def encode_texts(
    docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", memo_words: int = MEMO_WORDS
) -> DataFrame:
    """Token ids of every whole text and the text decoded from them: ``key, ids, decoded``.

    ``model`` is the content of a model file, which travels with the tasks.
    ``memo_words`` bounds what a worker remembers; fewer take less memory and more time.
    A null text counts as empty; an empty text has no ids and decodes to an
    empty text. Null keys and repeated rows are kept as they are; other columns
    take no part, whatever their names. One narrow pass, no shuffle: a lost
    executor costs the rerun of its own partitions.
    """

    def make():
        memo = worker_memo("piece_table")
        key_of = hash(model), memo_words
        if key_of not in memo:
            memo[key_of] = PieceTable(model, memo_words)
        table = memo[key_of]

        def step(cols: dict) -> dict:
            ids = [table.encode(t) for t in cols["text"]]
            return {"key": cols["key"], "ids": ids, "decoded": [table.decode(i) for i in ids]}

        return step

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(rows, make, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)
