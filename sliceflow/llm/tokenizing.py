"""Token ids of whole texts with the tokenizers library, with a cache of pieces.

A text is cut where its pre-tokenizer is certain to cut too, so the ids of the
pieces, one after the other, are the ids of the whole text. Pieces recur, so
most of them come from a cache, and no encoding object of a long text is ever
made.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import chain

import numpy as np

from sliceflow.llm.common import per_process

#: pieces kept in a worker; when there are more, those of the last slice of texts
#: stay, which changes speed only
CACHE = 900_000
#: white space other than space and line feed
_ODD = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"
#: runs of three spaces and line feeds, which pre-tokenizers treat as a whole
_RUNS = [a + b + c for a in " \n" for b in " \n" for c in " \n"]
_UNITS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
_ASCII_BLANK = re.compile(r"[ \t\r\n]+")
#: what every pre-tokenizer here cuts alike: runs of Latin letters, digits and ASCII
#: marks; an apostrophe may begin a contraction and is left to the library
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "!-&(-/:-@\\[-`{-~"
_WORD = re.compile(f"[{_LETTERS}]+")
_PLAIN, _PARTS = re.compile(f"[0-9{_LETTERS}{_MARKS}]+"), re.compile(f"[{_LETTERS}]+|[0-9]+|[{_MARKS}]+")
#: byte-level tokenizers write bytes that are not printable as code points from 256 on
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_WRITTEN = {c: "".join(chr(_BYTE_CHARS.get(b, b)) for b in chr(c).encode()) for c in (0x20, *range(0xC0, 0x100))}
#: before a piece that is not to get a space: a code point no text can hold
_AS_IS = "\ud800"


class _Kept(dict):
    """What ``make`` gives for each key, made once."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        self[key] = value = self.make(key)
        return value


class CachedEncoder:
    """Ids as of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``;
    with ``plain`` the strings of special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False, keep: int = CACHE):
        from tokenizers import Tokenizer

        self.keep = keep
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.tokenizer.encode_special_tokens = plain
        simple = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"])) for a in added)
        # byte-level: a space belongs to the word after it, other white space is alone
        self.spaced = simple and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        # pre-tokenizer that keeps only matches without white space
        steps = pre.get("pretokenizers") or [{}]
        self.blank_free = (simple and pre.get("type") == "Sequence" and steps[0].get("type") == "Split" and steps[0].get("invert")
                           and steps[0].get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", ""))
        self.added = [] if plain else [t["content"] for t in added]
        self._model = self.tokenizer.model.tokenize
        self.runs, self.cache = _Kept(self._run), _Kept(self._piece)

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of what the pre-tokenizer would find: it goes to the model at once."""
        if run == "\n":
            return self._encode(run)
        if not self.spaced:
            run = run.lower()
        if not run.isascii():
            run = run.translate(_WRITTEN)
        elif run[0] == " ":
            run = _WRITTEN[0x20] + run[1:]
        return array("I", [t.id for t in self._model(run)]).tobytes()

    def _piece(self, p: str) -> bytes:
        """Ids of a piece. Pieces of plain runs are made of the ids of these."""
        if not (self.spaced or self.blank_free):
            return self._encode(p)
        if p.isalpha():  # the usual ones first
            if p.isascii() or _WORD.fullmatch(p):
                return self.runs[" " + p if self.spaced else p]
        elif p[-1:] in (".", ","):
            word = p[:-1]
            if word.isalpha() and (word.isascii() or _WORD.fullmatch(word)):
                return self.runs[" " + word if self.spaced else word] + self.runs[p[-1]]
        text = self._text(p)
        body = text.lstrip(" \n")
        before = text[:len(text) - len(body)]
        if before not in ("", " ", "\n") or not _PLAIN.fullmatch(body) or "<" in body and any(a in body for a in self.added):
            return self._encode(text)
        found = _PARTS.findall(body)
        if self.blank_free:
            if any(map(str.isdigit, found)):  # every digit is alone
                found = [y for x in found for y in (x if x.isdigit() else (x,))]
        elif before == " ":
            found[0] = " " + found[0]
        elif before:
            found.insert(0, "\n")
        return self.runs[found[0]] if len(found) == 1 else b"".join(map(self.runs.__getitem__, found))

    def _pieces(self, text: str) -> list[str]:
        """Pieces whose ids, one after the other, are the ids of ``text``. In
        spaced mode the first stands for itself, as do those that begin with a
        line feed or a mark; the others have a space before them."""
        if self.blank_free:  # a cut at ASCII white space is a cut of the pre-tokenizer
            return _ASCII_BLANK.split(text) if "\t" in text or "\r" in text else text.replace("\n", " ").split(" ")
        if not self.spaced:
            return [text]
        odd = any(c in text for c in _ODD)
        if odd or any(r in text for r in _RUNS) or text[-2:] in ("  ", " \n", "\n ", "\n\n") or any(a in text for a in self.added):
            units = _UNITS.findall(text) if not odd or not any(c in text for c in _ODD[2:]) else [text]
            return [_AS_IS + u for u in units]
        # every space or line feed starts a piece
        parts = text.replace("\n", " \n").split(" ")
        parts[0] = _AS_IS + parts[0]
        return parts

    def _text(self, piece: str) -> str:
        if piece[:1] == _AS_IS:
            return piece[1:]
        return piece if not self.spaced or piece[:1] == "\n" else " " + piece

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        parts = [self._pieces(t) for t in texts]
        if len(self.cache) > self.keep:  # what these texts need stays
            held = self.cache
            self.runs, self.cache = _Kept(self._run), _Kept(self._piece)
            self.cache.update((p, held[p]) for p in set(chain.from_iterable(parts)) if p in held)
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, p)), dtype="<u4") for p in parts]


class PieceEncoder:
    """Ids as of ``SentencePieceProcessor(model_file=path).encode(text)``, for models that
    leave the text as it is, put a space before it and have no piece with a space after
    another sign. Such a model never merges over the end of a word or a line feed, so
    words are encoded once and kept."""

    #: words of a text: spaces go with the word after them, a line feed begins a new one
    WORDS = re.compile(r" +[^ \n]*|\n[^ \n]*")

    def __init__(self, path: str, keep: int = CACHE):
        from sentencepiece import SentencePieceProcessor

        self.keep = keep
        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.byte = [self.model.is_byte(i) for i in range(len(self.pieces))]
        #: bytes that an id stands for
        self.bytes = [bytes([int(p[3:5], 16)]) if b else p.replace("\u2581", " ").encode() for p, b in zip(self.pieces, self.byte)]
        probe = " ａ  ﬁ\tx "
        self.by_word = (b"".join([self.bytes[i] for i in self.model.encode(probe)]) == b" " + probe.encode()
                        and not any(re.search("[^\u2581]\u2581|\n", p) for p, b in zip(self.pieces, self.byte) if not b))
        self.cache: dict[str, bytes] = {}
        self.bad: set[str] = set()

    def _fill(self, words: list[str]) -> None:
        # the model puts a space before what it gets: words go without theirs, and what begins with a line feed loses the one it gets
        spaced = [w for w in words if w[0] == " " and len(w) > 1]
        other = [w for w in words if w[0] != " "]
        found = dict(zip(spaced, self.model.encode([w[1:] for w in spaced], num_threads=1)))
        found.update(zip(other, (x[1:] for x in self.model.encode(other, num_threads=1))))
        if " " in words:
            found[" "] = [self.model.piece_to_id("\u2581")]
        for w, ids in found.items():
            self.cache[w] = array("I", ids).tobytes()
            if b"".join([self.bytes[i] for i in ids]) != w.encode():
                self.bad.add(w)

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """uint32 ids of each text; None where their bytes are not those of the text
        with a space before it."""
        if not self.by_word:
            out = [np.array(x, dtype="<u4") for x in self.model.encode(texts, num_threads=1)]
            return [x if b"".join([self.bytes[i] for i in x]) == b" " + t.encode() else None for x, t in zip(out, texts)]
        parts = []
        for t in texts:
            if "  " in t or " \n" in t or t[:1] in " \n" or t[-1:] == " ":
                parts.append(self.WORDS.findall(" " + t))
            else:
                found = t.replace("\n", " \n").split(" ")
                parts.append([" " + w if w[:1] != "\n" else w for w in found])
        used = set(chain.from_iterable(parts))
        if len(self.cache) > self.keep:
            self.cache = {w: self.cache[w] for w in used if w in self.cache}
            self.bad &= used
        new = [w for w in used if w not in self.cache]
        if new:
            self._fill(new)
        return [None if self.bad and not self.bad.isdisjoint(p) else np.frombuffer(b"".join(map(self.cache.__getitem__, p)), dtype="<u4") for p in parts]


def piece_encoder(path: str, keep: int = CACHE) -> PieceEncoder:
    """The encoder of this process for a model file."""
    return per_process(("pieces", path, keep), lambda: PieceEncoder(path, keep))


def encoder(path: str, plain: bool = False, keep: int = CACHE) -> CachedEncoder:
    """The encoder of this process for a tokenizer file."""
    return per_process(("tokens", path, plain, keep), lambda: CachedEncoder(path, plain, keep))
