"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

1. Lookahead. A token is final once no further input can change it. Merges apply in order of rank, so a merge
   ``(x, w)`` across the end of a token can only be undone by an earlier merge across the end of ``w``, and so on:
   ranks fall along such a chain. One pass over the merge list gives, for each merge, the symbols
   from the start of ``w`` that decide it, and so the number of symbols, ``Vocabulary.lookahead``, from
   a token's start beyond which nothing matters.
2. Encoding. Texts are read in slices of about ``SLICE`` characters, cut where neither normalisation nor a
   pre-token nor an added token can be affected, if need be inside a run of letters or signs. The symbols of a pre-token go
   through a ``WordTransducer``, which keeps ``lookahead + STEP`` symbols at most and emits each token once it is stable.
   Tokens of short pre-tokens are remembered, of ``HELD`` at most.
3. Decoding. ``Decoder`` takes ids one run at a time: byte-level tokens become bytes, and bytes become text by an
   incremental UTF-8 state machine that keeps at most three bytes (malformed bytes give U+FFFD); without a decoder in the
   file, token strings are joined by one space.
4. Spark. Rows are encoded in Arrow batches where they lie: no shuffle; each task reads the vocabulary file of
   the installed tokenizer package (its place is a parameter) once.

Supported files are BPE models of the ``tokenizers`` format over byte-level symbols, with an optional
end-of-word mark, normalisers NFC, white-space replacement and lower case, either of the two usual word patterns, and the byte-level
decoder or none; others raise an error. Added tokens in a text become their ids, as in that library.

Defined cases: null and empty texts have no tokens and decode to the empty text; repeated rows are encoded
alike; lone surrogates can't occur in Spark strings; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from windshear.llm.common import map_rows

SLICE = 1 << 16
STEP = 1024
HELD = 150_000
LONG = 256
NEVER, IDS = 1 << 62, (1 << 32) - 1

# The contractions that both patterns split off.
SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
# As the files write them: words without white space, and words with their leading blank.
BARE = SHORT + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANKS = SHORT + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files: printable ones of Latin-1 stand for
    themselves, the others for U+0100 and on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def sufficient_lookahead(sizes: list[int], merges: list[tuple[int, int, int]]) -> int:
    """Symbols from a token's start that decide the token, for merges ``(left, right, new)`` by rank."""
    reach = [0] * len(sizes)  # symbols beyond a token's end that decide whether something crosses that end
    for left, right, new in merges:
        beyond = reach[right]
        reach[left] = max(reach[left], sizes[right] + beyond)
        reach[new] = max(reach[new], beyond)
    return max((n + r for n, r in zip(sizes, reach)), default=1)


class Vocabulary:
    """A BPE model file: symbols, merges, and how its texts are cut."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("only byte-level BPE models are supported")
        self.tokens = sorted(model["vocab"], key=model["vocab"].get)
        ids = model["vocab"]
        if [ids[t] for t in self.tokens] != list(range(len(ids))):
            raise ValueError("the ids of the vocabulary have gaps")
        self.end = model.get("end_of_word_suffix") or ""
        chars = byte_symbols()
        self.inner = [ids[c] for c in chars]
        self.last = [ids[c + self.end] for c in chars]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        # The rank of a pair from 1, and the id that it merges to, in one number.
        self.rank = {(a, b): (r << 32) + new for r, (a, b, new) in enumerate(merges, 1)}
        mark = len(self.end)
        self.sizes = [len(t) - mark if mark and t.endswith(self.end) and len(t) > mark else len(t) for t in self.tokens]
        self.lookahead = sufficient_lookahead(self.sizes, merges)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens") or []):
            raise ValueError("added tokens that strip or match normalised text are not supported")
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        for content, i in self.added.items():
            if i == len(self.tokens):
                self.tokens.append(content)
            elif i > len(self.tokens) or self.tokens[i] != content:
                raise ValueError("the ids of added tokens must follow the vocabulary's")
        self._steps(spec.get("normalizer"))
        self._pattern(spec.get("pre_tokenizer"))
        decoder = (spec.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder} is not supported")
        self.bytes_out = decoder == "ByteLevel"
        back = {c: b for b, c in enumerate(chars)}
        self.token_bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in self.tokens]

    def _steps(self, spec) -> None:
        steps = [] if not spec else spec["normalizers"] if spec["type"] == "Sequence" else [spec]
        names = [s["type"] for s in steps]
        blanks = [s for s in steps if s["type"] == "Replace"]
        if names not in ([], ["NFC", "Replace", "Lowercase"]) or any(
                (s["pattern"], s["content"]) != ({"Regex": r"\s+"}, " ") for s in blanks):
            raise ValueError("this sequence of normalisers is not supported")
        self.normalised = bool(names)

    def _pattern(self, spec) -> None:
        parts = spec["pretokenizers"] if spec and spec["type"] == "Sequence" else [spec]
        last = parts[-1] or {}
        ok = last.get("type") == "ByteLevel" and not last["add_prefix_space"]
        if ok and len(parts) == 1 and last["use_regex"]:
            own, ascii_only = BLANKS, (SHORT + "| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
        elif (ok and len(parts) == 2 and not last["use_regex"] and parts[0]["type"] == "Split" and parts[0]["invert"]
                and parts[0]["behavior"] == "Removed" and parts[0]["pattern"] == {"Regex": BARE}):
            own, ascii_only = BARE, SHORT + "|[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+"
        else:
            raise ValueError("this pre-tokenizer is not supported")
        self.single_digits = own is BARE
        self.words = regex.compile(own.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.ascii_words = re.compile(ascii_only)

    def normalise(self, text: str) -> str:
        """One slice, normalised. White space is left: the pattern drops it, as it would the replaced one."""
        if not self.normalised:
            return text
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # The library lowers character by character, without a final form of sigma.
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def find_words(self, text: str) -> list[str]:
        return self.ascii_words.findall(text) if text.isascii() else self.words.findall(text)

    def merge(self, symbols: list[int]) -> list[int]:
        """The tokens of a symbol sequence: merges by rank, the leftmost first."""
        if len(symbols) <= 64:
            out, get = list(symbols), self.rank.get
            pairs = [get(p, NEVER) for p in zip(out, out[1:])]
            while pairs and (best := min(pairs)) != NEVER:
                i = pairs.index(best)
                out[i:i + 2] = [best & IDS]
                del pairs[i]
                if i:
                    pairs[i - 1] = get((out[i - 1], out[i]), NEVER)
                if i < len(pairs):
                    pairs[i] = get((out[i], out[i + 1]), NEVER)
            return out
        rank = self.rank
        own, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(got, i) for i in range(n - 1) if (got := rank.get((own[i], own[i + 1])))]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i] if own[i] >= 0 else n
            if j >= n or rank.get((own[i], own[j])) != best:
                continue
            new = own[i] = best & IDS
            own[j] = -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if got := rank.get((new, own[after[i]])):
                    heapq.heappush(heap, (got, i))
            if (h := before[i]) >= 0 and (got := rank.get((own[h], new))):
                heapq.heappush(heap, (got, h))
        return [x for x in own if x >= 0]


class WordTransducer:
    """Tokens of one pre-token whose bytes come piece by piece; holds ``lookahead + STEP`` symbols at most."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.held, self.open = vocabulary, [], None

    def feed(self, data: bytes) -> Iterator[int]:
        """The tokens that are stable now; the last byte waits, as it may end the word."""
        inner, need = self.v.inner, self.v.lookahead
        for b in data:
            if self.open is not None:
                self.held.append(inner[self.open])
            self.open = b
            if len(self.held) >= need + STEP:
                at = 0
                for t in self.v.merge(self.held):
                    if at + need > len(self.held):
                        break
                    yield t
                    at += self.v.sizes[t]
                del self.held[:at]

    def finish(self) -> Iterator[int]:
        if self.open is not None:
            self.held.append(self.v.last[self.open])
        yield from self.v.merge(self.held)
        self.held, self.open = [], None


def _class(c: str) -> str:
    """Letter, number, blank or other, as the patterns see it."""
    kind = unicodedata.category(c)
    return kind[0] if kind[0] in "LN" else " " if c in "\x85" or (c.isspace() and not "\x1c" <= c <= "\x1f") else "O"


def cut_before(v: Vocabulary, text: str, start: int, stop: int) -> int:
    """The last place in ``(start, stop]`` at which a slice may end, or ``start``: at the end of the text, before a blank that follows
    none, or within a run of letters or other signs."""
    if stop >= len(text):
        return len(text)
    blank = max((text.rfind(c, start + 1, stop) for c in " \t\n"), default=-1)
    while blank > start and _class(text[blank - 1]) == " ":
        blank -= 1
    if blank > start and text[blank] < "\x80":
        return blank
    for at in range(stop, start + 3, -1):
        a, b = text[at - 1], text[at]
        kind = _class(a)
        if (kind not in "LO" or _class(b) != kind or unicodedata.category(b)[0] not in "LPS" or "ᄀ" <= b <= "ᇿ"
                or "'" in text[at - 3:at + 1]):
            continue
        if not any(text.find(t, max(start, at - len(t) + 1), at + len(t) - 1) >= 0 for t in v.added):
            return at
    return start


class Encoder:
    """Token ids of texts, slice by slice."""

    def __init__(self, vocabulary: Vocabulary, slice_size: int = SLICE):
        self.v, self.size = vocabulary, slice_size
        self.memo: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        got = self.memo.get(word)
        if got is None:
            data, v = word.encode(), self.v
            if len(data) <= v.lookahead:  # no token is stable before the end
                got = v.merge([*map(v.inner.__getitem__, data[:-1]), v.last[data[-1]]])
            else:
                run = WordTransducer(v)
                got = [*run.feed(data), *run.finish()]
            if len(word) <= LONG:
                if len(self.memo) >= HELD:
                    self.memo.clear()
                self.memo[word] = got
        return got

    def slices(self, text: str) -> Iterator[tuple[str, bool]]:
        """Slices of a text, and whether a run of letters or signs goes on in the next."""
        start = 0
        while start < len(text):
            stop = start + self.size
            while (cut := cut_before(self.v, text, start, stop)) == start:
                stop += self.size
            part = text[start:cut]
            yield part, cut < len(text) and _class(text[cut]) != " "
            start = cut

    def stream(self, text: str) -> Iterator[list[int]]:
        """The ids in lists, one or more for each slice."""
        open_word: WordTransducer | None = None
        kind = ""
        memo = self.memo
        for raw, goes_on in self.slices(text):
            segments = self._segments(raw)
            for n, (piece, added) in enumerate(segments):
                out: list[int] = []
                piece = self.v.normalise(piece)
                words = self.v.find_words(piece) if piece else []
                if open_word is not None:
                    if words and kind and _class(piece[0]) == kind and piece.startswith(words[0]):
                        out.extend(open_word.feed(words[0].encode()))
                        if len(words) == 1 and goes_on and n == len(segments) - 1 and _class(piece[-1]) == kind:
                            yield out
                            continue
                        words = words[1:]
                    out.extend(open_word.finish())
                    open_word = None
                held = words.pop() if goes_on and n == len(segments) - 1 and words and piece.endswith(words[-1]) else None
                for w in words:
                    got = memo.get(w)
                    out.extend(self.word(w) if got is None else got)
                if held is not None:
                    kind = _class(held[-1])
                    if kind in "LO":
                        open_word = WordTransducer(self.v)
                        out.extend(open_word.feed(held.encode()))
                    else:
                        out.extend(self.word(held))
                if added is not None:
                    out.append(added)
                yield out
        if open_word is not None:
            yield list(open_word.finish())

    def _segments(self, raw: str) -> list[tuple[str, int | None]]:
        """``(text, id of the added token after it)``; added tokens are found in the raw text."""
        if self.v.added_pattern is None:
            return [(raw, None)]
        out, at = [], 0
        for m in self.v.added_pattern.finditer(raw):
            out.append((raw[at:m.start()], self.v.added[m.group()]))
            at = m.end()
        return [*out, (raw[at:], None)]

    def encode(self, text: str | None) -> list[int]:
        return [i for part in self.stream(text or "") for i in part]


class Decoder:
    """Text of token ids that come in runs."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.started = vocabulary, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if self.v.bytes_out:
            own = self.v.token_bytes
            return self.utf8.decode(b"".join([own[i] for i in ids]))
        own = self.v.tokens
        out = " ".join([own[i] for i in ids])
        if ids and self.started:
            out = " " + out
        self.started = self.started or bool(ids)
        return out

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


def code(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row of ``docs(doc_id, text)``: every text encoded, and its ids decoded
    again. Hashes are fed run by run, so that neither ids nor decoded text are held whole."""
    state: list = []

    def run(cols):
        if not state:
            v = Vocabulary(path)
            state.extend((v, Encoder(v), [str(i) for i in range(len(v.tokens))]))
        v, encoder, decimal = state
        out = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in cols["text"]:
            n, ids, back, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(v)
            for part in encoder.stream(text or ""):
                if part:
                    ids.update(((" " if n else "") + " ".join([decimal[i] for i in part])).encode())
                    back.update(decoder.feed(part).encode())
                    n += len(part)
            back.update(decoder.finish().encode())
            out["n_tokens"].append(n)
            out["ids_sha256"].append(ids.hexdigest())
            out["decoded_sha256"].append(back.hexdigest())
        return out

    return map_rows(docs, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id", "text"], chunk=64)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` per row of ``docs(doc_id, text)``."""
    state: list = []

    def run(cols):
        if not state:
            state.append(Encoder(Vocabulary(path)))
        return {"doc_id": cols["doc_id"], "ids": [np.array(state[0].encode(t), np.int32) for t in cols["text"]]}

    return map_rows(docs, run, "doc_id long, ids array<int>", ["doc_id", "text"], chunk=64)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` per row of ``rows(doc_id, ids)``; null ids give the empty text."""
    state: list = []

    def run(cols):
        if not state:
            state.append(Vocabulary(path))
        texts = []
        for ids in cols["ids"]:
            d = Decoder(state[0])
            texts.append(d.feed(ids or []) + d.finish())
        return {"doc_id": cols["doc_id"], "text": texts}

    return map_rows(rows, run, "doc_id long, text string", ["doc_id", "ids"], chunk=64)
