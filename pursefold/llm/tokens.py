"""Token ids of whole texts by the tokenizers library, fast: equal words are encoded once.

A text is cut at single ASCII spaces between two characters that are not white space. Neither tokenizer's splitting pattern
runs across such a place, so the ids of the pieces (each with its leading space) put together are the ids of the text. Pieces
and their ids are kept in a table bounded in entries and, as pieces of over `LONGEST` characters are left out, in bytes. A
text with any other white space beside a space is encoded whole, unless white space carries no ids (`spaces=False`).
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 1 << 20
LONGEST = 64
SIGNS, MOST_SIGNS = string.punctuation.replace("'", ""), 8
#: How the byte-level vocabulary writes a space (fixed value).
SPACE = "Ġ"
#: How the vocabulary of words writes the end of one (fixed value).
END = "</w>"
TOGETHER = 64
CHUNK = 4 << 20


class Encoder:
    """`ids(texts)`: for each text its ids as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str, spaces: bool, limit: int = LIMIT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces, self.limit, self.known, self.old = spaces, limit, {}, {}
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("A") == "a"
        names = [self.tokenizer.id_to_token(k) for k in range(self.tokenizer.get_vocab_size())]
        self.begins, self.ends = np.array([n.startswith(SPACE) for n in names]), np.array([n.endswith(END) for n in names])
        self.signs = {"": b""}
        # Normalizer and pattern leave words of a to z as they are, so these need the model only.
        self.small = Tokenizer(self.tokenizer.model)
        self.small.pre_tokenizer = WhitespaceSplit()

    def whole(self, texts: list[str], small: bool = False) -> list[bytes]:
        """small: the texts are words of a to z with single spaces between, and white space carries no ids."""
        tokenizer = self.small if small else self.tokenizer
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _clean(self, part: str) -> bool:
        return not self.spaces or bool(part) and not part[0].isspace() and not part[-1].isspace()

    def _apart(self, parts: list[str]) -> list[bytes]:
        """The ids of each piece with a space before it: encoded together, and cut where an id begins with a space or ends a word."""
        if not self.spaces:
            return self._words(parts)
        found = []
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            ids = self.whole([" " + " ".join(some)])[0]
            cuts = np.flatnonzero(self.begins[np.frombuffer(ids, "<u4")]) * 4
            found += [ids[a:b] for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)])]
        return found

    def _words(self, parts: list[str]) -> list[bytes]:
        """As `_apart` where white space carries no ids. Pieces of letters only are one word each; others may be several."""
        found = dict.fromkeys(parts)
        letters = [p for p in parts if p.isalpha()]
        for small in (True, False):
            words = [p for p in letters if (p.isascii() and p.islower()) == small]
            groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
            for some, ids in zip(groups, self.whole([" ".join(g) for g in groups], small)):
                cuts = ((np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1) * 4).tolist()
                if len(cuts) == len(some):  # else lower case or the pattern makes several of one: these are encoded alone
                    found.update(zip(some, (ids[a:b] for a, b in zip([0, *cuts], cuts))))
        alone = [p for p, ids in found.items() if ids is None]
        found.update(zip(alone, self.whole([f" {p}" for p in alone])))
        return [found[p] for p in parts]

    def _plain(self, piece: str) -> tuple[str, str]:
        """A piece's word, in lower case where the tokenizer makes it so, and the few signs (stops, brackets) that it ends with.

        Both patterns cut before these signs and take them as one, and the word alone is often known. Only after Latin letters, which
        both patterns take as such, in lower case too.
        """
        word = piece.rstrip(SIGNS)
        sign = piece[len(word) :]
        if sign and not (len(sign) <= MOST_SIGNS and word[-1:] <= "ÿ" and word[-1:].isalpha()):
            word, sign = piece, ""
        return word.lower() if self.lowers and word.isascii() else word, sign

    def _learn(self, new: list[str]) -> list[bytes | None]:
        """Ids of pieces that are not known, which then are; None for those that are not clean."""
        known, old, signs = self.known, self.old, self.signs
        plain = list(map(self._plain, new))
        alone = [w for w in dict.fromkeys(w for w, _ in plain) if w not in known]
        known.update((w, old.get(w)) for w in alone)
        usable = [w for w in alone if known[w] is None and self._clean(w)]
        known.update(zip(usable, self._apart(usable)))
        if len(signs) > self.limit:
            signs.clear()
        fresh = list({sign for _, sign in plain} - signs.keys())
        signs.update(zip(fresh, self.whole(fresh)))
        found = [None if known[w] is None else known[w] + signs[sign] for w, sign in plain]
        known.update(zip(new, found))
        for long in (x for p, (w, _) in zip(new, plain) if len(p) > LONGEST for x in (p, w) if len(x) > LONGEST):
            known.pop(long, None)
        return found

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        if len(self.known) > self.limit // 2:
            self.old, self.known = self.known, {}
        column = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not len(column):
            return []
        split = pc.split_pattern(column if self.spaces else pc.replace_substring(column, "\n", " "), " ")
        flat = split.flatten().dictionary_encode()
        words, places = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), flat.indices.to_numpy()
        parts = list(map(self.known.get, words))
        missing = [k for k, ids in enumerate(parts) if ids is None]
        again = list(map(self.old.get, [words[k] for k in missing]))
        self.known.update((words[k], ids) for k, ids in zip(missing, again) if ids is not None)
        new = [k for k, ids in zip(missing, again) if ids is None]
        for k, ids in [*zip(missing, again), *zip(new, self._learn([words[k] for k in new]))]:
            parts[k] = ids
        bounds = np.asarray(split.value_lengths()).cumsum()
        firsts = np.r_[0, bounds[:-1]]
        odd = np.zeros(len(column), bool)
        if None in parts:
            odd = np.logical_or.reduceat(np.array([ids is None for ids in parts])[places], firsts)
            parts = [ids or b"" for ids in parts]
        # Texts that must be encoded whole have their ids in place of their first piece's, as have first pieces that no space precedes.
        instead = np.flatnonzero(odd | self.spaces)
        parts += self.whole([column[k].as_py() if odd[k] else words[places[firsts[k]]] for k in instead.tolist()])
        places = places.astype(np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        counts = sizes[places]
        if odd.any():
            counts[np.repeat(odd, bounds - firsts)] = 0
        places[firsts[instead]] = np.arange(len(words), len(parts))
        counts[firsts[instead]] = sizes[len(words) :]
        pool, ends = np.frombuffer(b"".join(parts), "<u4"), counts.cumsum()
        shift = (sizes.cumsum() - sizes)[places] - (ends - counts)
        at = np.repeat(shift.astype(np.int32), counts)
        at += np.arange(len(at), dtype=np.int32)
        data = pool[at].tobytes()
        cuts = [0, *(ends[bounds - 1] * 4).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def chunks(batch: pa.RecordBatch, text: int, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many bytes of text, or of one row."""
    upto = np.r_[0, pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64).cumsum()]
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


@cache
def encoder(path: str, spaces: bool) -> Encoder:
    """One for each worker process, whose tasks share what it knows."""
    return Encoder(path, spaces)
