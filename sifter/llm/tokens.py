"""Batch encoding with the ``tokenizers`` library, each distinct word once.

A text falls into pieces that the library would treat one by one anyway: it may be cut before a
single space between two characters that are not white space, and around a single line break
between two such characters. Ids of pieces are kept, up to a bound, and texts are put together from
them. Merging words dominates a BPE encoder's time and most words recur, so this is several times
cheaper than encoding whole texts.
"""

from __future__ import annotations

import gc
import re
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept, about 230 bytes each; beyond this those used most are.
MAX_PIECES = 500_000
#: Words that are encoded in one call.
RUN = 500
#: Marks that, in a row at the end, stand as a piece of their own after a word of letters only.
_MARKS = string.punctuation
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_CUT = re.compile(r"(?<=\S) (?=\S)")



def _plain_case(text: str) -> bool:
    """Lower case here and in the library is surely the same."""
    return "\u03a3" not in text and "\u0130" not in text and unicodedata.is_normalized("NFC", text)


_encoders: dict = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Codes(dict):
    """Piece -> code; a new piece gets the next code and waits in the encoder's ``todo``;
    ``behind`` says whether a space stands before it."""

    def __init__(self, spaced: bool, encoder: Encoder):
        self.spaced, self.encoder = spaced, encoder

    def __missing__(self, piece: str) -> int:
        e = self.encoder
        code = self[piece] = e.known + len(e.todo)
        e.todo.append(piece)
        e.behind.append(self.spaced)
        return code


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # strings of special tokens get their ids, as by the library's default, and only in their own case
        special = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.normalized or t.single_word or t.content.split() != [t.content] for t in special):
            raise ValueError("special tokens that take in what stands around them are not supported")
        self.special = [t.content.lower() for t in special]
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        names = [""] * self.size
        for name, i in vocab.items():
            names[i] = name
        self.names = names
        # which tokens begin or end a word: lets many words be encoded in one call
        self.word_ends = sum(n.endswith("</w>") for n in names) > 1000
        self.edge = np.array([n.endswith("</w>") if self.word_ends else n.startswith("Ġ") for n in names])
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = line[0] if len(line) == 1 else -1
        self._reset()

    def _reset(self) -> None:
        self.known, self.todo, self.behind = 0, [], bytearray()
        self.spaced = _Codes(True, self)
        self.plain = self.spaced if self.word_ends else _Codes(False, self)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library's encode_batch(add_special_tokens=False) gives them."""
        collecting = gc.isenabled()
        gc.disable()  # strings and numbers make no cycles, and there are too many to go through them each time
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.known > MAX_PIECES:
            self._prune()
        odd: list[int] = []  # codes of texts whose white space needs a closer look
        bounds = np.zeros((len(texts), 2), np.int64)
        simple, places = [], []
        spaced, plain = self.spaced.__getitem__, self.plain.__getitem__
        for k, text in enumerate(texts):
            if not text:
                continue
            if self.word_ends and (text.isascii() or _plain_case(text)):
                low = text.lower()  # as the library will; fewer pieces differ
                text = text if any(t in low for t in self.special) else low
            if (
                "  " in text or " \n" in text or "\n " in text or "\n\n" in text
                or text[0] in " \n" or text[-1] in " \n" or _RARE_SPACE.search(text)
            ):
                bounds[k, 0] = len(odd)
                first, *rest = _CUT.split(text)
                odd.append(plain(first))
                odd.extend(map(spaced, rest))
                bounds[k, 1] = len(odd)
            else:
                places.append(k)
                simple.append(text.replace("\n", " \n"))
        at = np.array(odd, np.int64)
        if simple:
            codes, upto = self._words(simple)
            bounds[places] = len(at) + np.stack([upto[:-1], upto[1:]], axis=1)
            at = np.concatenate([at, codes])
        self._resolve()
        self.uses += np.bincount(at, minlength=self.known).astype(np.int32)
        n = self.length[at]
        upto = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        flat = self.ids[np.repeat(self.begin[at] - upto[:-1], n) + np.arange(upto[-1])]
        return [flat[a:b] for a, b in upto[bounds].tolist()]

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts in turn, and where each text's begin: single spaces between words, line
        breaks at the head of words. Only the distinct words are looked up."""
        spaced, plain = self.spaced.__getitem__, self.plain.__getitem__
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten().dictionary_encode()
        place, names = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)
        line = pc.starts_with(words.dictionary, "\n").to_numpy(zero_copy_only=False)
        heads = place[offsets[:-1]]
        inside = np.bincount(place, minlength=len(names)) > np.bincount(heads, minlength=len(names))
        code = np.zeros(len(names), np.int64)
        inside &= ~line
        code[inside] = list(map(spaced, names[inside].tolist()))
        code[line] = [plain(w[1:]) for w in names[line].tolist()]
        codes = code[place]
        codes[offsets[:-1]] = list(map(plain, names[heads].tolist()))
        if self.word_ends or not line.any():
            return codes, offsets
        broken = line[place]
        before = np.concatenate([[0], np.cumsum(broken)])
        out = np.repeat(codes, 1 + broken)
        out[np.flatnonzero(broken) + before[:-1][broken]] = plain("\n")
        return out, offsets + before[offsets]

    def _ids(self, text: str) -> np.ndarray:
        """Ids without places in the text, which nobody needs."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _prune(self) -> None:
        """Keep the pieces used most, up to half of MAX_PIECES, of those that came again."""
        often = max(2, int(np.partition(self.uses, -MAX_PIECES // 2)[-MAX_PIECES // 2])) if self.known > MAX_PIECES // 2 else 2
        keep = np.flatnonzero(self.uses >= often)[: MAX_PIECES // 2]
        place = np.full(self.known, -1, np.int32)
        place[keep] = np.arange(len(keep), dtype=np.int32)
        n = self.length[keep]
        upto = np.cumsum(n, dtype=np.int64) - n
        self.ids = self.ids[np.repeat(self.begin[keep] - upto, n) + np.arange(n.sum())]
        self.begin, self.length, self.uses = upto, n, self.uses[keep] // 2
        self.known = len(keep)
        place = place.tolist()
        for table in {id(t): t for t in (self.spaced, self.plain)}.values():
            kept = [(p, place[c]) for p, c in table.items() if place[c] >= 0]
            table.clear()
            table.update(kept)

    def _resolve(self) -> None:
        """Ids of the pieces that are new, as runs of one array."""
        done, todo, behind = self.known, self.todo, self.behind
        words, single, joined, stems, marks, heads = [], [], [], [], [], []
        for k, piece in enumerate(todo, done):  # grows by the stems of marked words
            spaced = behind[k - done]
            if piece.isalpha():
                (words if spaced else heads).append(k)
                continue
            stem = piece.rstrip(_MARKS)
            if len(stem) < len(piece) and stem.isalpha() and stem[-1] != "\u0130":  # its lower case ends in a mark
                joined.append(k)
                stems.append((self.spaced if spaced else self.plain)[stem])
                marks.append(self.plain[piece[len(stem) :]])
            else:
                single.append(k)
        if not todo:
            return
        begin = np.concatenate([self.begin, np.zeros(len(todo), np.int64)])
        length = np.concatenate([self.length, np.zeros(len(todo), np.int32)])
        runs, at = [self.ids], len(self.ids)
        for i in range(0, len(words), RUN):
            part = words[i : i + RUN]
            ids = self._ids(" " + " ".join([todo[k - done] for k in part]))
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == len(part) and len(ids):
                ends = edges + 1 if self.word_ends else np.append(edges[1:], len(ids))
                begin[part] = at + np.append(0, ends[:-1])
                length[part] = np.diff(ends, prepend=0)
                runs.append(ids)
                at += len(ids)
            else:
                single.extend(part)
        for i in range(0, len(heads), RUN):  # words without a space before: one a line
            part = heads[i : i + RUN]
            ids = self._ids("\n".join([todo[k - done] for k in part]))
            breaks = np.flatnonzero(ids == self.line_break)
            if len(breaks) == len(part) - 1:
                starts = np.append(0, breaks + 1)
                begin[part], length[part] = at + starts, np.append(breaks, len(ids)) - starts
                runs.append(ids)
                at += len(ids)
            else:
                single.extend(part)
        texts = [" " * behind[k - done] + todo[k - done] for k in single]
        for k, e in zip(single, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            begin[k], length[k] = at, len(ids)
            runs.append(ids)
            at += len(ids)
        flat = np.concatenate(runs)
        if joined:
            # a stem and its mark lie apart: copy both behind one another
            pair = np.stack([stems, marks], axis=1).ravel()
            n = length[pair]
            upto = np.cumsum(n, dtype=np.int64) - n
            flat = np.concatenate([flat, flat[np.repeat(begin[pair] - upto, n) + np.arange(n.sum())]])
            begin[joined], length[joined] = at + upto[::2], n[::2] + n[1::2]
        self.begin, self.length, self.ids = begin, length, flat
        self.uses = np.concatenate([self.uses, np.zeros(len(todo), np.int32)])
        self.known, self.todo, self.behind = done + len(todo), [], bytearray()


def slices(column: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of a column's texts of about ``size`` bytes, as (from, to, texts); nulls are empty. Only
    one run at a time is a Python list."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(column):
        before = upto[begin - 1] if begin else 0
        end = min(int(np.searchsorted(upto, before + size)) + 1, len(column))
        yield begin, end, [t or "" for t in column.slice(begin, end - begin).to_pylist()]
        begin = end
