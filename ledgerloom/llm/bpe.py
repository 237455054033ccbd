"""Byte-level BPE of whole texts by a backtracking encoder, and decoding by an offset table.

A piece of text is encoded from left to right. At each place the longest token is
tried, then the shorter ones that begin it. A token is taken if it is compatible
with the one before, that is, if merging the bytes of both gives just these two
tokens; a row of tokens is the result of the merges exactly if all neighbours are
compatible. Where nothing fits, the last token is given back and its end is never
tried again, so each place is left at most once and the work is linear.

The longest tokens come from one Aho-Corasick pass over the piece. The vocabulary
is read once by the driver and sent to the tasks; its size does not depend on the
corpus.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Fixed value: how a byte-level vocabulary cuts a text before it merges.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Texts are cut into pieces over so many characters at a time.
STRETCH = 1 << 20
# Pieces of up to so many characters are remembered, so many of them.
KEPT_LENGTH, KEPT_PIECES = 48, 1 << 18
KEPT_PAIRS = 1 << 18
# Bytes of encoded or decoded rows handed on at a time.
OUT_BYTES = 16 << 20
NEVER = 1 << 62


def byte_marks() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file.

    Bytes that print in Latin-1 stand for themselves; the others follow from code point 256 on.
    """
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    marks = {chr(b): b for b in printing}
    for place, b in enumerate(sorted(set(range(256)) - set(printing))):
        marks[chr(256 + place)] = b
    return marks


class Vocabulary:
    """Tokens, merges and added tokens of a vocabulary file, and the tables made from them.

    Only what the file holds travels to the tasks; tables are made there on first use.
    """

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]], added: dict[str, int], other: str):
        self.tokens, self.merges, self.added, self.other = tokens, merges, added, other
        self._made: dict = {}

    def __getstate__(self):
        return {**self.__dict__, "_made": {}}

    def made(self, name: str, make):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    """A vocabulary file of the tokenizers library: byte-level BPE without normalizer, prefix space or dropout.

    Files of another kind are refused. Characters that the library takes for
    neither letter, number nor space although the pattern engine here does (its
    Unicode tables are older) are asked from it once, see ``unlike``.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, before = found["model"], found["pre_tokenizer"] or {}
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not found.get("normalizer")
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(t.get(k) for t in found["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take their surroundings into account")
    marks, vocab = byte_marks(), model["vocab"]
    added = {t["content"]: t["id"] for t in found["added_tokens"]}
    tokens = {n: bytes(marks[c] for c in text) for text, n in vocab.items() if all(c in marks for c in text)}
    tokens |= {n: text.encode() for text, n in added.items()}
    merges = []
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((vocab[left], vocab[right], vocab[left + right]))
    return Vocabulary(tokens, merges, added, unlike(path))


def unlike(path: str) -> str:
    """Characters that the library's splitter and the pattern engine here put into different classes, as class ranges.

    Only assigned characters can be letters, numbers or spaces, so only these are asked.
    """
    import regex
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    engine = regex.compile(PIECES)
    wanted = regex.findall(r"[\p{L}\p{N}\s]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
    points = []
    for at in range(0, len(wanted), 4096):
        text = "".join(f"a{c}1{c}!{c}" for c in wanted[at : at + 4096])
        theirs = {span[0] for _, span in split(text)}
        ours = {found.start() for found in engine.finditer(text)}
        points += [ord(wanted[at + (place // 6)]) for place in {p - p % 6 for p in theirs ^ ours}]
    # A character next to one of another class may show its neighbour's difference: ask again, one by one.
    alone = lambda c: f"a{c}1{c}!{c}!"
    near = {q for p in points for q in (p - 1, p, p + 1) if 0 <= q < 0x110000 and not 0xD800 <= q < 0xE000}
    differ = sorted(
        p for p in near if {s[0] for _, s in split(alone(chr(p)))} != {f.start() for f in engine.finditer(alone(chr(p)))}
    )
    out, first = [], None
    for place, p in enumerate(differ):
        first = p if first is None else first
        if place + 1 == len(differ) or differ[place + 1] != p + 1:
            out.append(f"\\U{first:08x}-\\U{p:08x}")
            first = None
    return "".join(out)


class Kept(dict):
    """Packed numbers of the pieces seen so far; long pieces are worked out each time."""

    def __init__(self, work):
        self.work = work

    def __missing__(self, piece: str) -> bytes:
        ids = self.work(piece.encode("utf-8", "surrogatepass")).tobytes()
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts with the tables of a vocabulary, which it shares with the other encoders of its process."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        made = vocabulary.made("tables", lambda: tables(vocabulary))
        self.pair, self.left, self.right, self.made_at = made["pair"], made["left"], made["right"], made["made_at"]
        self.whole, self.shorter, self.sizes = made["whole"], made["shorter"], made["sizes"]
        self.automaton, self.cut, self.high, self.odd, self.cut_odd, self.special = made["cutting"]
        self.seams = made["seams"]
        self.kept = vocabulary.made("kept", lambda: Kept(self.piece))

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens leaves these two: no merge joins them over the seam.

        A part of ``a`` that ends at the seam lives until the merge that takes it
        into the next larger part; a part of ``b`` likewise. A pair of parts is
        joined if its merge comes before the left one is taken by its left
        neighbour, and not after the right one is taken by its right neighbour:
        of equal merges the leftmost goes first.
        """
        key = a << 32 | b
        found = self.seams.get(key)
        if found is None:
            found = True
            ends = [(a, NEVER)]
            while (part := self.right[ends[-1][0]]) >= 0:
                ends.append((part, self.made_at[ends[-1][0]]))
            begin, until = b, NEVER
            while found and begin >= 0:
                for end, end_until in ends:
                    at = self.pair.get((end, begin), NEVER)
                    if at < end_until and at <= until and at < NEVER:
                        found = False
                        break
                begin, until = self.left[begin], self.made_at[begin]
            if len(self.seams) >= KEPT_PAIRS:
                self.seams.clear()
            self.seams[key] = found
        return found

    def piece(self, raw: bytes) -> array:
        """Token numbers of one piece, as its merges give them."""
        whole = self.whole.get(raw)
        if whole is not None:
            return array("I", (whole,))
        n, sizes, shorter, seams = len(raw), self.sizes, self.shorter, self.seams
        text, longest = raw.decode("latin-1"), [-1] * (n + 1) if n < STRETCH else array("i", [-1]) * (n + 1)
        for end, token in self.automaton.iter(text):
            # Ends rise, so the last token noted for a start is its longest.
            longest[end + 1 - sizes[token]] = token
        open_at = bytearray(b"\x01") * (n + 1)
        out, at, token, last = array("I"), 0, longest[0], -1
        while at < n:
            end = at + sizes[token]
            if open_at[end]:
                fits = last < 0 or seams.get(last << 32 | token)
                if self.compatible(last, token) if fits is None else fits:
                    out.append(token)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                # No token goes on from here: this place is closed, and the one that led to it gives way.
                open_at[at] = 0
                at -= sizes[out.pop()]
                token, last = shorter[last], out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Token numbers of a whole text, packed as little-endian unsigned 32-bit integers."""
        out = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            self._plain(text[at : found.start()], out)
            out.append(array("I", (self.vocabulary.added[found[0]],)).tobytes())
            at = found.end()
        self._plain(text[at:] if at else text, out)
        return b"".join(out)

    def _plain(self, text: str, out: list[bytes]) -> None:
        # One comparison a character settles most texts; the many ranges are looked through for the others.
        cut = self.cut_odd if self.odd and self.high.search(text) and self.odd.search(text) else self.cut
        kept, at, width = self.kept, 0, STRETCH
        while at < len(text):
            part = text if at == 0 and len(text) <= width else text[at : at + width]
            pieces = cut.findall(part)
            if at + len(part) < len(text):
                # The last piece of a stretch may go on beyond it, and so may a contraction, of three characters at most.
                again = 0
                while pieces and again < 3:
                    again += len(pieces.pop())
                if not pieces:
                    width *= 2
                    continue
                at += len(part) - again
            else:
                at = len(text)
            width = STRETCH
            out.append(b"".join(map(kept.__getitem__, pieces)))


def tables(vocabulary: Vocabulary) -> dict:
    """Parts of each token, ranks of pairs, the tokens that merging can give, and the automaton over them."""
    import ahocorasick
    import regex

    size = max([0, *vocabulary.tokens]) + 1
    left, right, made_at = [-1] * size, [-1] * size, [-1] * size
    pair: dict[tuple[int, int], int] = {}
    for rank, (a, b, whole) in enumerate(vocabulary.merges):
        if made_at[whole] >= 0 or made_at[a] >= rank or made_at[b] >= rank or (a, b) in pair:
            raise ValueError("a merge is given twice, or before its parts")
        left[whole], right[whole], made_at[whole] = a, b, rank
        pair[a, b] = rank
    sizes = [0] * size
    for token, raw in vocabulary.tokens.items():
        sizes[token] = len(raw)
    special = sorted(vocabulary.added, key=len, reverse=True)
    out = {"pair": pair, "left": left, "right": right, "made_at": made_at, "sizes": sizes, "seams": {}}
    out |= {"whole": {}, "shorter": [-1] * size, "cutting": (None,) * 6}
    maker = Encoder.__new__(Encoder)
    maker.pair, maker.left, maker.right, maker.made_at, maker.seams = pair, left, right, made_at, {}
    whole = out["whole"]
    # A token counts if merging its own bytes gives it: byte by byte, or by parts that count and meet before it is made.
    for token, raw in sorted(vocabulary.tokens.items(), key=lambda t: made_at[t[0]]):
        if token in vocabulary.added.values():
            continue
        if len(raw) == 1 or (
            made_at[token] >= 0
            and whole.get(vocabulary.tokens[left[token]]) == left[token]
            and whole.get(vocabulary.tokens[right[token]]) == right[token]
            and met(maker, left[token], right[token], made_at[token])
        ):
            whole[raw] = token
    automaton = ahocorasick.Automaton()
    for raw, token in whole.items():
        automaton.add_word(raw.decode("latin-1"), token)
        out["shorter"][token] = next((whole[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in whole), -1)
    automaton.make_automaton()
    odd = vocabulary.other
    # A differing character is neither letter, number nor space to the library.
    pattern = PIECES
    if odd:
        pattern = (
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?![{odd}])\p{{L}})+| ?(?:(?![{odd}])\p{{N}})+"
            rf"| ?(?:[^\s\p{{L}}\p{{N}}]|[{odd}])+|\s+(?!\S)|\s+"
        )
    out["cutting"] = (
        automaton,
        regex.compile(PIECES),
        regex.compile(rf"[^\x00-\U{int(odd[2:10], 16) - 1:08x}]") if odd else None,
        regex.compile(f"[{odd}]") if odd else None,
        regex.compile(pattern),
        regex.compile("|".join(map(regex.escape, special))) if special else None,
    )
    return out


def met(maker: Encoder, a: int, b: int, rank: int) -> bool:
    """Whether the parts of a token are first joined over their seam by the token's own merge."""
    ends, begins = [(a, NEVER)], [(b, NEVER)]
    while (part := maker.right[ends[-1][0]]) >= 0:
        ends.append((part, maker.made_at[ends[-1][0]]))
    while (part := maker.left[begins[-1][0]]) >= 0:
        begins.append((part, maker.made_at[begins[-1][0]]))
    joined = [
        at
        for end, end_until in ends
        for begin, begin_until in begins
        if (at := maker.pair.get((end, begin), NEVER)) < end_until and at <= begin_until and at < NEVER
    ]
    return min(joined, default=NEVER) == rank


def offsets(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens behind each other, where each begins, and how long it is; numbers without a token have none."""
    size = max([0, *vocabulary.tokens]) + 1
    lengths = np.zeros(size + 1, np.int64)
    for token, raw in vocabulary.tokens.items():
        lengths[token] = len(raw)
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    data = b"".join(vocabulary.tokens.get(token, b"") for token in range(size))
    return np.frombuffer(data, np.uint8), begins, lengths


def decoded(vocabulary: Vocabulary, packed: bytes, stretch: int = STRETCH) -> bytes:
    """The bytes that packed token numbers stand for; numbers outside the vocabulary stand for none."""
    data, begins, lengths = vocabulary.made("offsets", lambda: offsets(vocabulary))
    ids = np.frombuffer(packed, "<u4")
    out = []
    for at in range(0, len(ids), stretch):
        part = np.minimum(ids[at : at + stretch], len(lengths) - 1)
        size = lengths[part]
        ends = np.cumsum(size)
        place = np.repeat(begins[part] - (ends - size), size) + np.arange(int(ends[-1]))
        out.append(data[place].tobytes())
    return b"".join(out)


def in_parts(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``OUT_BYTES``; a row is a tuple whose last entry is its size."""
    held, total = [], 0
    for *row, size in rows:
        held.append(row)
        total += size
        if total >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of every row of ``docs``, encoded without added special tokens.

    ``path`` is a vocabulary file. ``ids`` is binary: the token numbers as
    little-endian unsigned 32-bit integers, see ``unpacked``. A special token's
    own string within a text becomes that token, as in the library. A null or
    empty text has no tokens; repeated rows and null ids stay; further columns
    are left behind. Nothing is shuffled. One text is held by a task with its
    numbers, and nothing else that grows with it but a piece without a break
    (nine bytes a byte of it).
    """
    plain = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kind = plain.schema["doc_id"]

    def encoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)

        def rows(batch):
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encoder.encode(text.as_py() or "")
                yield doc_id.as_py(), len(ids) // 4, ids, len(ids) + 16

        for batch in batches:
            yield from in_parts(rows(batch), ["doc_id", "n_tokens", "ids"], [batch.schema.field(0).type, pa.int64(), pa.binary()])

    schema = T.StructType([kind, *T.StructType.fromDDL("n_tokens long, ids binary")])
    return plain.mapInArrow(encoding, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text of its column ``ids`` as ``decoded``, special tokens included.

    Bytes that are no UTF-8 (numbers cut out of a longer row may give such) become
    U+FFFD as in the library. Null numbers give a null text. Other columns stay
    as they are; one named ``decoded`` is replaced.
    """
    rest = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*[f"`{c}`" for c in rest])
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def decoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Short slices, as a text is longer than its numbers.
            step = max(1, int(len(batch) * OUT_BYTES / max(1, batch.nbytes)))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                texts = [
                    None if ids is None else decoded(shared.value, ids).decode("utf-8", "replace")
                    for ids in part.column(part.schema.get_field_index("ids")).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*rest, "decoded"])

    return source.mapInArrow(decoding, T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())]))


def unpacked(packed: bytes) -> list[int]:
    """Token numbers out of the packed form."""
    return np.frombuffer(packed, "<u4").tolist()
