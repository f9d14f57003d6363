"""Token ids of whole texts by public tokenizers; a chunk between two spaces that came before costs one look-up.

A text is cut at its single spaces. Neither tokenizer lets a token reach over such a place, so the ids of a text are
those of its chunks in turn. Texts with other white space beside a space, or with what may be the name of a special
token, go to the tokenizer whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

#: Chunks after which the older half of what a worker remembers goes; results don't depend on it.
CHUNKS_KEPT = 500_000
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
#: Chunks for which the byte-level split is known without asking the tokenizer.
PLAIN = re.compile(r"[ \n!-~À-ÖØ-öø-ÿ]+")
SPLIT = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_LETTERS}0-9 \n]+|[ \n]+(?![^ \n])|[ \n]+")
#: Signs that end many chunks and are split off.
SIGNS = ",.;:!?"
SPACE = "▁"


class WholeText(Exception):
    """The text of this chunk has to be encoded whole."""


class _Chunks(dict):
    """Ids of `` chunk`` (a space before it) as little-endian unsigned 32-bit numbers."""

    #: Whether chunks over a line end are remembered; they are long and hardly any comes twice.
    lines = True

    def __init__(self, table: list[bytes] | None = None, kept: int = CHUNKS_KEPT):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.table, self.kept = table, kept

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self.encoded(chunk)
            if self.table is not None and not self.spells(found, " " + chunk):
                raise WholeText
            if not self.lines and "\n" in chunk:
                return found
        self[chunk] = found
        return found

    def spells(self, ids: bytes, text: str) -> bool:
        """Whether the bytes that ``table`` has for the ids are those of the text."""
        return b"".join(map(self.table.__getitem__, memoryview(ids).cast("I"))) == text.encode("utf-8", "replace")

    def spelled(self, chunks: list[str], text: str) -> bytes | None:
        """Ids of a space and ``text``, whose ``chunks`` these are; None if they don't spell it."""
        ids = self.together(chunks)
        if ids is None:
            ids = self.whole(text)
            return ids if self.spells(ids, " " + text) else None
        return ids

    def together(self, chunks: list[str]) -> bytes | None:
        """Ids of all chunks; None if the text has to be encoded whole."""
        if len(self) > self.kept:
            self.older.clear()  # before the younger half is copied, so that no more than two halves are held at a time
            self.older.update(self)
            self.clear()
        try:
            return b"".join(map(self.__getitem__, chunks))
        except WholeText:
            return None


class ByteIds(_Chunks):
    """Ids of a byte-level tokenizer without special tokens added.

    With ``plain`` the names of special tokens inside texts are text like any other.
    """

    def __init__(self, path: str, plain: bool = False, table: list[bytes] | None = None,
                 kept: int = CHUNKS_KEPT):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__(table, kept)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        signs = [chr(c) for c in range(256) if PLAIN.match(chr(c))]
        self.to_bytes = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in signs}
        self.merge, self.parts = self.tokenizer.model.tokenize, {}

    def merged(self, run: str) -> bytes:
        return array("I", [token.id for token in self.merge(run)]).tobytes()

    def part(self, part: str) -> bytes:
        """Ids of one run of the tokenizer's own split. A run with a space before it is a chunk, too."""
        if part[0] == " " and len(part) > 1 and part[1] not in " \n":
            return self[part[1:]]
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > self.kept // 4:
                self.parts.clear()
            self.parts[part] = ids = self.merged(part.translate(self.to_bytes))
        return ids

    def encoded(self, chunk: str) -> bytes:
        if chunk.isalpha():
            if chunk.isascii():
                return self.merged(self.to_bytes[32] + chunk)
            if PLAIN.fullmatch(chunk):
                return self.merged((" " + chunk).translate(self.to_bytes))
        elif chunk != chunk.strip() or not chunk or "<|" in chunk:
            raise WholeText
        elif chunk[-1] in SIGNS and (word := chunk[:-1]).isalpha() and word.isascii():
            return self[word] + self.part(chunk[-1])
        elif PLAIN.fullmatch(chunk):
            before, end, after = chunk.partition("\n")
            if after.isalpha():  # one line end alone is a run of its own
                return (self.get(before) or self.encoded(before)) + self.part(end) + self.part(after)
            first, *rest = SPLIT.findall(" " + chunk)
            head = self.part(first) if rest else self.merged(first.translate(self.to_bytes))
            return head + b"".join(map(self.part, rest))
        return self.whole(chunk)

    def whole(self, text: str) -> bytes:
        """The ids of a space and ``text``, in one go."""
        return array("I", self.tokenizer.encode(" " + text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        first, *rest = text.split(" ")
        found = None
        if first == first.strip() and "<|" not in first and (rest or PLAIN.fullmatch(first)):
            found = self.together(rest)
        if found is None:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if PLAIN.fullmatch(first):
            return b"".join(map(self.part, SPLIT.findall(first))) + found
        return array("I", self.tokenizer.encode(first, add_special_tokens=False).ids).tobytes() + found


class PieceIds(_Chunks):
    """Ids of a sentencepiece model that puts a space before each text."""

    def __init__(self, path: str, table: list[bytes] | None = None):
        from sentencepiece import SentencePieceProcessor

        super().__init__(table)
        self.model = SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.apart = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)

    def encoded(self, chunk: str) -> bytes:
        if chunk != chunk.strip() or not chunk or SPACE in chunk:
            raise WholeText
        return array("I", self.model.encode(chunk, num_threads=1)).tobytes()

    def together(self, chunks: list[str]) -> bytes | None:
        return super().together(chunks) if self.apart else None

    def whole(self, text: str) -> bytes:
        return array("I", self.model.encode(text, num_threads=1)).tobytes()

    def encode(self, text: str) -> bytes:
        found = self.together(text.split(" "))
        return self.whole(text) if found is None else found


@lru_cache(maxsize=1)
def byte_ids(path: str) -> ByteIds:
    """One per Python worker, which Spark uses for many tasks."""
    tokens = ByteIds(path, kept=6 * CHUNKS_KEPT // 5)
    tokens.lines = False
    return tokens
