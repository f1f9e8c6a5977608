"""Order-preserving packing of tokenised documents into sequences of a fixed window.

Documents keep the order in which their partition holds them (sort the table first for another
order). Per partition, dynamic programming chooses the cuts between windows: a cut at the end of a
document is free, one at the end of a sentence costs little, any other costs more, and every window
pays for its padding. The cheapest last cut for each place comes from a monotone queue, so the work
is linear in the number of places.
"""

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import chunks, id_and_text, text_buffer

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
SENTENCE_CUT, INNER_CUT = 2, 24
# Places nearer than this to the last sentence cut are no cuts; longer gaps get inner cuts.
CUT_GAP = 32
# Tokens that one run of the dynamic programming looks at.
BLOCK_TOKENS = 1 << 18
# Fixed value: how a byte-level BPE splits a text into words, if its file asks for its own pattern.
SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
)
# Settings of a BPE model under which a word's ids depend on more than its bytes.
_OTHER_MODEL = (
    *("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"),
    *("byte_fallback", "fuse_unk", "ignore_merges"),
)
_memory: dict = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def _byte_ranks(settings: dict) -> dict[bytes, int] | None:
    """Ids by bytes, if the file is a plain byte-level BPE whose merged tokens are numbered in the order
    of the merges: then the id of a merge's result is its rank. None for any other tokenizer."""
    split = dict(settings["pre_tokenizer"] or {})
    split.pop("trim_offsets", None)
    model = settings["model"]
    if (
        settings["normalizer"] is not None
        or split != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        or model["type"] != "BPE"
        or any(model.get(k) for k in _OTHER_MODEL)
    ):
        return None
    vocabulary, added = model["vocab"], {a["content"] for a in settings["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocabulary[left + right] for left, right in pairs]
    bytes_of = {letter: byte for byte, letter in BYTE_LETTERS.items()}
    single = [vocabulary.get(letter, 1 << 32) for letter in bytes_of]
    if merged != sorted(set(merged)) or max(single) >= min(merged, default=1 << 32):
        return None
    words = {token: i for token, i in vocabulary.items() if token not in added}
    if len(words) != len(single) + len(merged):
        return None
    return {bytes(bytes_of[c] for c in token): i for token, i in words.items()}


class Tokens:
    """Ids of texts and where their sentences end.

    The ids are those of the tokenizer file. A plain byte-level BPE is run by tiktoken, over the file's own
    vocabulary and several times as fast; its tests hold it against the file's tokenizer. Texts with an
    added token, and all texts of other tokenizers, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.added = [a["content"] for a in settings["added_tokens"]]
        ranks = _byte_ranks(settings)
        self.fast = ranks and tiktoken.Encoding(
            "file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token[-1] in ".!?" or "\u010a" in token  # U+010A stands for a line feed

    def _ids(self, text: str) -> list[int]:
        if self.fast and not any(token in text for token in self.added):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, places after a sentence's last token) of each text."""
        for text in texts:
            ids = np.frombuffer(array("I", self._ids(text)), np.uint32)
            yield ids, np.flatnonzero(self.ends[ids]) + 1


def tokens_for(path: str) -> Tokens:
    if path not in _memory:
        _memory.clear()
        _memory[path] = Tokens(path)
    return _memory[path]


def thinned(ends: np.ndarray, length: int, gap: int = CUT_GAP) -> tuple[list, list]:
    """Cut places of one document and their costs: sentence ends `gap` apart, inner cuts in longer
    gaps, the document's end."""
    places, costs, last = [], [], 0
    for end in [*ends.tolist(), length]:
        if end - last < gap and end != length or not 0 < end <= length or end <= last:
            continue
        while end - last > 2 * gap:
            last += gap
            places.append(last)
            costs.append(INNER_CUT)
        places.append(end)
        costs.append(0 if end == length else SENTENCE_CUT)
        last = end
    return places, costs


def cheapest_cuts(places, costs, window: int) -> list[int]:
    """Indexes into `places` (rising, gaps of at most `window`) at which windows end, the last one
    among them, with the smallest sum of padding and cut costs. Ties take the earlier cut."""
    queue = deque([(0, 0, -1)])  # place, cost up to it plus place, index
    before = [0] * len(places)
    for j, place in enumerate(places):
        while place - queue[0][0] > window:
            queue.popleft()
        _, cost, before[j] = queue[0]
        total = cost + window - place + costs[j] + place
        while queue and queue[-1][1] > total:
            queue.pop()
        queue.append((place, total, j))
    cuts, j = [], len(places) - 1
    while j >= 0:
        cuts.append(j)
        j = before[j]
    return cuts[::-1]


class Packer:
    """Packs a stream of documents; the last window of a block goes on in the next one."""

    def __init__(self, window: int, first_id: int):
        self.window, self.sequence = window, first_id
        self.docs: list = []  # id, all ids, first id not packed yet, cut places, costs
        self.size = 0
        self.rows: list = []

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> None:
        places, costs = thinned(ends, len(ids), min(CUT_GAP, self.window))
        self.docs.append((doc_id, ids, 0, places, costs))
        self.size += len(ids)
        if self.size >= BLOCK_TOKENS:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        places, costs, base = [], [], 0
        for _, ids, done, own, own_costs in self.docs:
            for place, cost in zip(own, own_costs):
                if place > done:
                    places.append(base + place - done)
                    costs.append(cost)
            base += len(ids) - done
        if not places:
            return
        cuts = [places[j] for j in cheapest_cuts(places, costs, self.window)]
        if not last:
            cuts.pop()
        elif rest := cuts.pop() - (cuts[-1] if cuts else 0):
            at = cuts[-1] if cuts else 0
            for bit in range(rest.bit_length() - 1, -1, -1):  # powers of two need no padding
                if rest >> bit & 1:
                    at += 1 << bit
                    cuts.append(at)
        self.emit(cuts)

    def emit(self, cuts: list[int]) -> None:
        at, k = 0, 0  # place in the block, document
        for cut in cuts:
            offset = 0
            while at < cut:
                doc_id, ids, done, places, costs = self.docs[k]
                take = min(cut - at, len(ids) - done)
                crc = zlib.crc32(ids[done : done + take].astype("<u4").tobytes())
                self.rows.append((doc_id, done, take, crc, len(ids), self.sequence, offset))
                at, offset, done = at + take, offset + take, done + take
                self.docs[k] = (doc_id, ids, done, places, costs)
                k += done == len(ids)
            self.sequence += 1
        self.docs = self.docs[k:]
        self.size -= at

    def taken(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = list(zip(*self.rows)) or [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence of at most `window` tokens.

    A null or empty text is its `end_id` alone. A null id is kept. Rows with equal ids are packed
    each on its own. An empty table has no pieces. The last tokens of a partition, fewer than a
    window, go into sequences whose lengths are powers of two. `sequence_id` holds the partition in
    its upper bits, so that a task that runs again gives the same ids.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        tokens = tokens_for(tokenizer_path)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for low, high in chunks(offsets):
                part = batch.slice(low, high - low)
                found = tokens.of(part.column(1).to_pylist())
                for doc_id, (ids, ends) in zip(part.column(0).to_pylist(), found):
                    packer.add(doc_id, np.append(ids, np.uint32(end_id)), ends)
                yield packer.taken()
        packer.flush(last=True)
        yield packer.taken()

    return id_and_text(docs, id_col, text_col).mapInArrow(work, PIECES)
