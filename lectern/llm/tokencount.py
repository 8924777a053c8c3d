"""Token counts, with overlap resynchronisation for huge documents.

Texts of up to ``CHUNK`` characters are counted piece by piece: a text is cut
before each single space between other characters, where no pre-token can
reach across, and the counts of pieces met before are kept.

Huge texts are encoded as overlapping chunks with offsets. Two neighbours are
spliced at a token boundary that both have inside their overlap and that is
proven stable: the pre-tokeniser always cuts there, whatever stands around, so
the tokens after it are those of the whole text. Chunks are laid so that each
overlap has such a place in its middle, found by a scan before anything is
encoded; where it lies far off, the chunk is as long as that, and a text
without any is one piece. Where the two chunks don't align, the overlap is
doubled, up to encoding both in one. So each character is encoded about once.

Defined results: a null text has no bytes and no tokens. The tokeniser's
special strings inside texts count as the library counts them by default.
"""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit
from lectern.llm.bytebpe import independent_parts

CHUNK, OVERLAP = 64_000, 256
CACHE = 200_000
LIMIT = 512
#: Where every pre-tokeniser at hand cuts: before a space between letters.
_BETWEEN_WORDS = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_CJK = "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3"
#: Where one that takes runs of letters, of digits and of other marks apart cuts as well; no apostrophe is near.
_BETWEEN_RUNS = re.compile(rf"(?<=[^\W_])(?=[ \n])|(?<=[A-Za-z])(?=[0-9.,;:!?(])|(?<=[0-9])(?=[A-Za-z.,;:!?(])|(?<=[.,;:!?)。，、！？；：])(?=[A-Za-z0-9{_CJK}])|(?<=[{_CJK}])(?=[0-9.,。，、！？；：])")


class Counts:
    """Token counts of one vocabulary file; build it once per worker with ``shared``."""

    _shared: dict[str, Counts] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level pre-tokenisers with their own pattern keep letters, digits and other marks apart.
        kind = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        self.stable = _BETWEEN_RUNS if kind.get("type") == "ByteLevel" and kind.get("use_regex") else _BETWEEN_WORDS
        self.cache: dict[str, int] = {}

    @classmethod
    def shared(cls, path: str) -> Counts:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part_lengths(self, parts: list[str]) -> list[int]:
        """Token counts of independent parts, from one encoding of all: a part without a leading space goes first."""
        parts_at = sorted(range(len(parts)), key=lambda i: parts[i].startswith(" "))
        lead = sum(not p.startswith(" ") for p in parts)
        if lead > 1:
            return self._lengths(parts)
        ends = list(accumulate(len(parts[i]) for i in parts_at))
        starts = self._starts("".join(parts[i] for i in parts_at))
        cuts = [0, *(bisect.bisect_left(starts, e) for e in ends)]
        out = [0] * len(parts)
        for k, i in enumerate(parts_at):
            out[i] = cuts[k + 1] - cuts[k]
        return out

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Number of tokens of text."""
        if len(text) > chunk:
            return self.resynchronised(text, chunk, overlap)
        parts = None if any(s in text for s in self.specials) else independent_parts(text)
        if parts is None:
            return self._lengths([text])[0] if text else 0
        try:
            return sum(map(self.cache.__getitem__, parts))
        except KeyError:
            new = [p for p in set(parts) if p not in self.cache]
            if len(self.cache) + len(new) > CACHE:
                self.cache.clear()
                new = list(set(parts))
            self.cache.update(zip(new, self._part_lengths(new), strict=True))
            return sum(map(self.cache.__getitem__, parts))

    def _starts(self, text: str) -> list[int]:
        """Offset at which each token starts, in characters."""
        return [a for a, _ in self.tokenizer.encode(text, add_special_tokens=False).offsets]

    def _place(self, text: str, lo: int) -> int | None:
        """The first stable place from lo on."""
        m = self.stable.search(text, lo)
        while m and self._splits_special(text, m.start()):
            m = self.stable.search(text, m.start() + 1)
        return m and m.start()

    def _splice(self, text: str, mine: tuple[int, list[int]], theirs: tuple[int, list[int]], place: int, end: int) -> tuple[int, int] | None:
        """Numbers of the tokens, in two chunks given by start and offsets, that both start at one stable place: the given one, or the last before end."""
        others = (m.start() for m in reversed(list(self.stable.finditer(text, theirs[0] + 1, end))))
        for q in (place, *others):
            a, b = self._boundary(mine[1], q - mine[0]), self._boundary(theirs[1], q - theirs[0])
            if a is not None and b is not None and not self._splits_special(text, q):
                return a, b
        return None

    def resynchronised(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Number of tokens, from overlapping chunks spliced at stable common boundaries."""
        place = self._place(text, max(0, chunk - overlap))
        if place is None:
            return self._lengths([text])[0] if text else 0
        total, at, end = 0, 0, min(len(text), place + overlap)
        starts = self._starts(text[:end])  # of the tokens of text[at:end], counted from at
        while end < len(text):
            wide, splice = overlap, None
            while splice is None:
                base = max(at + 1, place - wide)
                further = self._place(text, max(end, base + chunk - overlap))
                until = len(text) if further is None else min(len(text), further + overlap)
                after = self._starts(text[base:until])
                splice = self._splice(text, (at, starts), (base, after), place, end)
                if base == at + 1:
                    break
                wide *= 2
            if splice is None:  # nowhere to splice: both as one chunk
                starts = self._starts(text[at:until])
            else:
                total += splice[0]
                starts, at = after[splice[1] :], base
            place, end = further, until
        return total + len(starts)

    @staticmethod
    def _boundary(starts: list[int], place: int) -> int | None:
        """Index of the first token at or after place, if one starts there (its space may be trimmed off)."""
        i = bisect.bisect_left(starts, place)
        return i if i < len(starts) and starts[i] in (place, place + 1) else None

    def _splits_special(self, text: str, place: int) -> bool:
        return any(s in text[max(0, place - len(s)) : place + len(s)] for s in self.specials)


def token_counts(docs: DataFrame, path: str, *, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[DataFrame, str]:
    """docs with a column of token counts; returns the frame and that column's name."""
    name = kit.free_name(docs, "n_tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.shared(path)
        for batch in batches:
            for part, texts in kit.cut(batch, text):
                n = [counts.count((t or b"").decode(), chunk, overlap) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], [*part.schema.names, name])
        counts.cache.clear()
        kit.release()

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])), name


def report(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    out, name = token_counts(docs.select(doc_id, text), path, text=text)
    return out.select(doc_id, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(name).alias("n_tokens"), (F.col(name) > limit).alias("over_limit"))
