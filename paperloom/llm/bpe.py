"""BPE encoding and decoding as bounded-lookahead streams.

The merge list fixes how far to the right a token can be decided: a merge is
undone only by an earlier-ranked one that takes its right part away, that one only
by a still earlier one further right, and so on. The longest such chain bounds the
lookahead. A word of any length is then cut through a window: tokens that end at
least that far from the window's end are final and leave it. Decoding runs the
token bytes through an incremental UTF-8 decoder. Splitting is done lazily, so
memory depends on the window, the bounded word cache and the batch alone.

The library that owns the file is used for its Unicode tables only, on texts with
characters too new for Python's own; merging and decoding are done here. Follows the file's own normaliser, splitter, special tokens and word ends.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm.bytetext import PIECE, lean

#: Words kept with their tokens in each of two generations. Only words of up to CACHED characters enter.
CACHE_WORDS, CACHED = 200_000, 32
#: Characters of a text that are cut into words at once.
SEGMENT = 1 << 18
#: From this many new words on they are merged together, in tables of at most CHUNK words.
TOGETHER, CHUNK = 128, 2048


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next character from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class MergeList:
    """Ranks, vocabulary and the lookahead they imply."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.vocab, self.end = vocab, end
        self.rank = {pair: r for r, pair in enumerate(dict.fromkeys(merges))}
        self.made: dict[str, tuple[int, str]] = {}
        for (a, b), r in self.rank.items():
            if r < self.made.get(a + b, (len(merges), ""))[0]:
                self.made[a + b] = (r, b)
        self.longest = max(map(len, vocab))
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Characters to the right that may still change whether a merge happens.

        ``reach`` of a merge: the length of its right part plus the farthest
        reach of an earlier merge whose left part is that right part, or a
        right-hand descendant of it that is consumed later than that merge.
        """
        earlier: dict[str, tuple[list[int], list[int]]] = {}
        most = 0
        for (a, b), r in sorted(self.rank.items(), key=lambda x: x[1]):
            best, part, until = 0, b, r
            while part:
                ranks, reach = earlier.get(part, ((), ()))
                at = bisect.bisect_left(ranks, until)
                if at:
                    best = max(best, reach[at - 1])
                until, part = self.made.get(part, (0, ""))
            total = len(b) + best
            ranks, reach = earlier.setdefault(a, ([], []))
            ranks.append(r)
            reach.append(max(total, reach[-1] if reach else 0))
            most = max(most, total)
        return most

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the earliest-ranked pair, leftmost first, until none is left."""
        rank = self.rank
        if len(symbols) > 64:
            return self._merge_long(symbols)
        none = len(rank)
        ranks = [rank.get(p, none) for p in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((symbols[i], symbols[i + 1]), none)
            if i:
                ranks[i - 1] = rank.get((symbols[i - 1], symbols[i]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        rank, n = self.rank, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i] if symbols[i] else n
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (p := (symbols[x], symbols[after[x]])) in rank:
                    heapq.heappush(heap, (rank[p], x, p))
        return [s for s in symbols if s]

    @cached_property
    def tables(self) -> tuple[np.ndarray, ...]:
        """Symbols by number: of each byte, of each byte at the end of a word, sorted pairs that merge, their ranks, the symbol a rank makes, and the id of each symbol (-1 outside the vocabulary)."""
        numbers: dict[str, int] = {}
        number = lambda symbol: numbers.setdefault(symbol, len(numbers))
        alphabet = byte_alphabet()
        single = np.array([number(alphabet[b]) for b in range(256)])
        last = np.array([number(alphabet[b] + self.end) for b in range(256)])
        pairs = np.array([(number(a), number(b), number(a + b)) for a, b in self.rank], np.int64).reshape(-1, 3)
        keys = (pairs[:, 0] << 32) + pairs[:, 1]
        ranks = np.argsort(keys)
        return single, last, keys[ranks], ranks, pairs[:, 2], np.array([self.vocab.get(symbol, -1) for symbol in numbers])

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        _, _, keys, ranks, made, _ = self.tables
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return np.where(keys[at] == wanted, ranks[at], len(made)) if len(keys) else np.full(wanted.shape, 0)

    def merge_words(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The rounds of ``merge`` on many words at once, one pair of each word a round: places of the words in the list, the ids of all one after the other, and how many each word has."""
        single, last, _, _, made, ids = self.tables
        none = len(made)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for first in range(0, len(words), CHUNK):
            places = order[first : first + CHUNK]
            size = lengths[places]
            n, width = len(places), int(size.max())
            inside = np.arange(width) < size[:, None]
            letters = np.zeros((n, width), np.uint8)
            letters[inside] = np.frombuffer(b"".join([words[i] for i in places.tolist()]), np.uint8)
            symbols = single[letters]
            symbols[np.arange(n), size - 1] = last[letters[np.arange(n), size - 1]]
            ranks = np.full((n, width), none)
            ranks[:, :-1] = np.where(inside[:, 1:], self._rank_of(symbols[:, :-1], symbols[:, 1:]), none)
            after = np.tile(np.arange(1, width + 1), (n, 1))
            before = after - 2
            live = np.arange(n)
            while True:
                # The first of the least ranks of a word is the leftmost.
                at = ranks[live].argmin(1)
                best = ranks[live, at]
                live, at, best = live[best < none], at[best < none], best[best < none]
                if not len(live):
                    break
                gone = after[live, at]
                then = after[live, gone]
                symbols[live, at], after[live, at] = made[best], then
                inside[live, gone], ranks[live, gone], ranks[live, at] = False, none, none
                more = then < size[live]
                row, here, then = live[more], at[more], then[more]
                before[row, then] = here
                ranks[row, here] = self._rank_of(symbols[row, here], symbols[row, then])
                ahead = before[live, at]
                row, here, ahead = live[ahead >= 0], at[ahead >= 0], ahead[ahead >= 0]
                ranks[row, ahead] = self._rank_of(symbols[row, ahead], symbols[row, here])
            found = ids[symbols]
            # A symbol outside the vocabulary has no id and leaves no token.
            inside &= found >= 0
            yield places, found[inside], inside.sum(1)

    def tokens(self, chars: Iterator[str]) -> Iterator[str]:
        """Tokens of one word, given as its characters, each as soon as it is stable.

        A suffix of final tokens retokenises to itself, so the window may start
        at any final border.
        """
        window, hold = [], 4 * (self.lookahead + self.longest)
        last = None
        for c in chars:
            if last is not None:
                window.append(last)
            last = c
            if len(window) >= hold:
                left = len(window)
                for token in self.merge(list(window)):
                    if left - len(token) < self.lookahead + self.longest:
                        break
                    left -= len(token)
                    yield token
                window = window[len(window) - left :]
        if last is not None:
            yield from self.merge([*window, last + self.end])


class Codec:
    """The transducer for one tokenizer file of the kind described in the module."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"] or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError(f"{path}: another kind of tokenizer file")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = MergeList(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.alphabet = byte_alphabet()
        self.bytes_of = {c: b for b, c in self.alphabet.items()}
        self.text_of = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.path = path
        self.cache: dict[str, tuple[bytes, int, str]] = {}
        self.older: dict[str, tuple[bytes, int, str]] = {}

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded where a text needs it."""
        return Tokenizer.from_file(self.path)

    def normalise(self, text: str) -> str:
        """Canonical composition and lower case, character by character.

        White space only parts words here, so it is left as it is.
        """
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def words(self, text: str) -> Iterator[list[str]]:
        """Words of a text without special tokens, a segment at a time; segments end before a blank."""
        lo = 0
        while lo < len(text):
            hi = text.find(" ", lo + SEGMENT)
            part = text[lo:] if hi < 0 else text[lo:hi]
            lo = len(text) if hi < 0 else hi
            if not part.isascii() and self.newer(part):
                cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                yield [bytes(self.bytes_of[c] for c in x).decode("utf-8") for x, _ in cut]
            else:
                yield self.pattern.findall(self.normalise(part))

    def newer(self, part: str) -> bool:
        """Does it hold characters that Python's Unicode tables do not know yet? The library's own then decide."""
        return any(unicodedata.category(c) == "Cn" for c in set(part))

    def word_ids(self, word: str) -> Iterator[int]:
        vocab, alphabet = self.merges.vocab, self.alphabet
        chars = map(alphabet.__getitem__, word.encode("utf-8")) if len(word) <= CACHED else (alphabet[b] for c in word for b in c.encode("utf-8"))
        # A symbol outside the vocabulary has no id and leaves no token.
        return (vocab[t] for t in self.merges.tokens(chars) if t in vocab)

    def run(self, ids: list[int]) -> tuple[bytes, int, str]:
        return np.array(ids, np.int32).tobytes(), len(ids), "".join(self.decode(iter(ids)))

    def segments(self, text: str) -> Iterator[list[str] | int]:
        """Words of a text, a segment at a time; a special token stands between them as its id."""
        for part in self.split_special.split(text) if "<|" in text else (text,):
            if part in self.special:
                yield self.special[part]
            else:
                yield from self.words(part)

    def known(self, words: Iterable[str]) -> dict[str, tuple[bytes, int, str]]:
        """Runs of different words but those too long to be remembered. New ones are merged together."""
        out, new = {}, []
        for word in words:
            if len(word) > CACHED:
                continue
            run = self.cache.get(word)
            if run is None:
                run = self.older.get(word)
                if run is None:
                    new.append(word)
                    continue
                self.remember(word, run)
            out[word] = run
        if len(new) < TOGETHER:
            made = ((word, self.run(list(self.word_ids(word)))) for word in new)
        else:
            made = self.merged(new)
        for word, run in made:
            self.remember(word, run)
            out[word] = run
        return out

    def remember(self, word: str, run: tuple[bytes, int, str]) -> None:
        if len(self.cache) >= CACHE_WORDS:
            # The full generation becomes the old one; words met again come back from it.
            self.older, self.cache = self.cache, {}
        self.cache[word] = run

    def merged(self, words: list[str]) -> Iterator[tuple[str, tuple[bytes, int, str]]]:
        for places, ids, sizes in self.merges.merge_words([word.encode("utf-8") for word in words]):
            raw, listed, lo = ids.astype(np.int32).tobytes(), ids.tolist(), 0
            for place, n in zip(places.tolist(), sizes.tolist()):
                hi = lo + n
                yield words[place], (raw[4 * lo : 4 * hi], n, "".join(self.decode(iter(listed[lo:hi]))))
                lo = hi

    def runs_of(self, words: list[str] | int, known: dict[str, tuple[bytes, int, str]]) -> list[tuple[bytes, int, str]]:
        """Ids as int32, their number and their decoded text for each word of a segment, those in ``known`` taken from there."""
        if isinstance(words, int):
            return [self.run([words])]
        found = list(map(known.get, words))
        if None not in found:
            return found
        out = []
        for word, run in zip(words, found):
            if run is not None:
                out.append(run)
                continue
            ids = self.word_ids(word)
            while block := list(islice(ids, 4096)):
                out.append(self.run(block))
        return out

    def runs(self, text: str) -> Iterator[list[tuple[bytes, int, str]]]:
        """Runs of the words of a text that have any token, a segment at a time."""
        for words in self.segments(text):
            known = {} if isinstance(words, int) else self.known(dict.fromkeys(words))
            yield [x for x in self.runs_of(words, known) if x[1]]

    def encode(self, text: str) -> Iterator[int]:
        for runs in self.runs(text):
            for ids, _, _ in runs:
                yield from _listed(ids)

    def decode(self, ids: Iterator[int]) -> Iterator[str]:
        """Text of a stream of ids, piece by piece, special tokens kept; an unknown id adds nothing.

        The file names no decoder, so its library joins the stored tokens with a
        blank and leaves their stand-in characters as they are.
        """
        first = True
        for i in ids:
            token = self.text_of.get(i)
            if token is None:
                continue
            yield token if first else " " + token
            first = False

    def plain_text(self, ids: Iterator[int]) -> Iterator[str]:
        """Readable text of a stream of ids: bytes behind the stand-ins, a blank for each word end."""
        state = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for i in ids:
            token = self.text_of.get(i, "")
            if i in self.special.values():
                yield state.decode(b"", True) + token
                state.reset()
                continue
            ended = token.endswith(self.merges.end)
            body = token[: -len(self.merges.end)] if ended else token
            yield state.decode(bytes(self.bytes_of[c] for c in body))
            if ended:
                yield state.decode(b"", True) + " "
                state.reset()
        yield state.decode(b"", True)


    def forget(self) -> None:
        """Let go of the remembered words."""
        self.cache, self.older = {}, {}


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _listed(ids: bytes) -> list[int]:
    return np.frombuffer(ids, np.int32).tolist()


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            counts, ids_sums, text_sums = [], [], []
            for value in batch.column(1):
                ids_sum, text_sum, n = hashlib.sha256(), hashlib.sha256(), 0
                for runs in c.runs(value.as_py() or ""):
                    if not runs:
                        continue
                    gap = " " if n else ""
                    n += sum([x[1] for x in runs])
                    ids_sum.update((gap + " ".join(map(str, _listed(b"".join([x[0] for x in runs]))))).encode("ascii"))
                    text_sum.update((gap + " ".join([x[2] for x in runs])).encode("utf-8"))
                counts.append(n)
                ids_sums.append(ids_sum.hexdigest())
                text_sums.append(text_sum.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sums), pa.array(text_sums)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _coded(path: str):
    """Words are forgotten at the end of a task, since its worker goes on to stages that need the memory."""

    def coded(c: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            while lo < len(sizes):
                hi, size = lo, 0
                while hi < len(sizes) and (hi == lo or size + sizes[hi] <= PIECE):
                    size, hi = size + sizes[hi], hi + 1
                cut = [list(c.segments(value.as_py() or "")) for value in batch.column(1).slice(lo, hi - lo)]
                # The new words of all these texts are merged at once.
                known = c.known(dict.fromkeys(chain.from_iterable(words for parts in cut for words in parts if not isinstance(words, int))))
                ids, texts = [], []
                for parts in cut:
                    # Decoded texts of words stand beside their ids; a blank joins them, as it joins tokens.
                    found = [x for words in parts for x in c.runs_of(words, known) if x[1]]
                    ids.append(np.frombuffer(b"".join([x[0] for x in found]), np.int32))
                    texts.append(" ".join([x[2] for x in found]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())], names=["id", "ids", "decoded"])
                lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        try:
            yield from coded(c, batches)
        finally:
            c.forget()

    return lean(run)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids, decoded`` per row: token ids and the text they decode to.

    A null or empty text has no ids and decodes to the empty text; rows are
    independent, so repeated rows and null ids come back as they are. Other
    columns are not read. ``path`` must be readable on every executor.
    """
    return _source(docs, id_col, text_col).mapInArrow(_coded(path), "id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of the same streams, without holding a text's ids."""
    return _source(docs, id_col, text_col).mapInArrow(_digests(path), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
