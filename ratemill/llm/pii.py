"""Personal data: fixed patterns, and a tagger trained beyond what they find.

The patterns give the base spans. A BiLSTM-CRF (``bilstm``) learns from windows of
the corpus labelled by them, in which half the spans are written in another form that
the patterns miss (``rewritten``: spaced, bracketed, spelt out), with their labels.
It reads every text in windows that overlap by ``MARGIN`` characters on either side.
Where two windows overlap, the scores of a character are averaged, weighted by how far
it is inside each; the joined scores of a text are then decoded once, by the CRF, so
transitions count across windows like anywhere else. Runs of a tag that are what their
kind says (``_form``) and touch no base span are added; base spans stay as they are.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratemill.llm.bilstm import Tagger

KINDS = ("email", "ip", "card", "phone")
UNITS = 8
CORE, MARGIN = 224, 16
#: Documents with this remainder of the hash of their text are held out of training.
FOLDS, HELD_OUT = 5, 0
#: Windows decoded at once, and characters of texts gathered for them.
WINDOWS_AT_ONCE = 1024
CHARACTERS_AT_ONCE = 1 << 19
#: Bounds of the training sample: documents, and windows of each.
TRAINING_DOCS, WINDOWS_PER_DOC, TRAINING_STEPS, TRAINING_BATCH = 1500, 6, 500, 96
TRAINING_WINDOW = 96

#: The patterns of the base spans, written so that each is linear.
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DIGIT = re.compile("[0-9]")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The run of allowed characters before an at sign, and a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        local = len(text[done:at]) - len(text[done:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end), in order; positions are code points."""
    found = [(start, 0, end) for start, end in _emails(text)]
    if not DIGIT.search(text):
        return found
    for rank, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        for match in pattern.finditer(text):
            if _holds(rank, match[0]):
                found.append((match.start(), rank, match.end()))
    return sorted(found)


def _is_ip(part: str) -> bool:
    numbers = part.split(".")
    return len(numbers) == 4 and all(
        re.fullmatch("0*([0-9]{1,3})", n) and int(n.lstrip("0") or 0) <= 255 for n in numbers
    )


def _holds(rank: int, part: str) -> bool:
    """Whether a match of a digit pattern counts."""
    if rank == 1:
        return _is_ip(part)
    digits = _digits(part)
    if rank == 2:
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return 10 <= len(digits) <= 15


#: How forms that the patterns miss are written, and read back.
AT, DOT = (" @ ", "(at)", " (at) ", "[at]", " [at] "), ("[.]", " . ", "(dot)", " (dot) ", "[dot]")
IP_DOT, CARD_GAP, PHONE_GAP = ("[.]", " . ", "(.)"), (".", "  ", " - ", "/"), ("/", " / ", " ", ".")
READ_AT = re.compile(r" *(?:@|\(at\)|\[at\]) *")
READ_DOT = re.compile(r" *(?:\.|\(dot\)|\[dot\]|\[\.\]|\(\.\)) *")
EMAIL_FORM = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CARD_FORM = re.compile(r"[0-9](?:[ ./-]{0,3}[0-9])+")
PHONE_FORM = re.compile(r"(?:\(?\+ ?|00 ?)([0-9][ ()./0-9-]+[0-9])")


def _form(rank: int, part: str) -> bool:
    """Whether a run of a tag is of its kind, in the forms of the patterns or others."""
    if rank == 0:
        return bool(EMAIL_FORM.fullmatch(READ_DOT.sub(".", READ_AT.sub("@", part))))
    if rank == 1:
        return _is_ip(READ_DOT.sub(".", part))
    if rank == 2:
        return bool(CARD_FORM.fullmatch(part)) and _holds(2, part)
    phone = PHONE_FORM.fullmatch(part)
    return bool(phone) and _holds(3, phone[1])


def rewritten(rank: int, part: str, random: np.random.Generator) -> str:
    """A base span in a form that its pattern misses; other values stay."""

    def one(choices: tuple[str, ...]) -> str:
        return choices[int(random.integers(len(choices)))]

    if rank == 0:
        local, domain = part.split("@")
        return local + one(AT) + domain.replace(".", one(DOT))
    if rank == 1:
        return part.replace(".", one(IP_DOT))
    digits, size = _digits(part), int(random.integers(2, 5))
    if rank == 2:
        return one(CARD_GAP).join(digits[at : at + 4] for at in range(0, len(digits), 4))
    groups = [digits[at : at + size] for at in range(2, len(digits), size)]
    return one(("+ ", "00", "00 ")) + digits[:2] + one(PHONE_GAP) + one(PHONE_GAP).join(groups)


def vary(text: str, seed: int) -> tuple[str, list[tuple[int, int, int]]]:
    """``text`` with half its base spans rewritten, and where all of them are now."""
    random = np.random.default_rng(seed % (1 << 32))
    parts, spans, done, length = [], [], 0, 0
    for start, rank, end in base_spans(text):
        if start < done:  # of spans that overlap, the first
            continue
        part = text[start:end]
        if random.random() < 0.5:
            part = rewritten(rank, part, random)
        length += start - done
        spans.append((length, rank, length + len(part)))
        length += len(part)
        parts += [text[done:start], part]
        done = end
    return "".join([*parts, text[done:]]), spans


def kinds_table() -> np.ndarray:
    """Kind of every character below 128, 0 being what pads windows; others are letters
    of another script, as far as the tagger is concerned."""
    alone = "@.-_%+() \n"
    kinds = np.full(129, 1 + len(alone), np.uint8)  # other marks
    for point in range(128):
        c = chr(point)
        if c in alone:
            kinds[point] = 1 + alone.index(c)
        elif c.isalnum():
            kinds[point] = len(alone) + (2 if c.islower() else 3 if c.isupper() else 4)
    kinds[128] = len(alone) + 5
    return kinds


N_CHARACTER_KINDS = 16


def character_kinds(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return table[np.minimum(points, 128)]


def _cut(kinds: np.ndarray) -> np.ndarray:
    """Overlapping windows of a text, (windows, characters)."""
    count = -(-len(kinds) // CORE)
    padded = np.zeros(count * CORE + 2 * MARGIN, np.uint8)
    padded[MARGIN : MARGIN + len(kinds)] = kinds
    return np.lib.stride_tricks.sliding_window_view(padded, CORE + 2 * MARGIN)[::CORE]


def joined_scores(texts: list[str], tagger: Tagger, table: np.ndarray) -> list[np.ndarray]:
    """Scores (tags, characters) of every text, averaged where windows overlap.

    They take some twenty bytes a character, of one long text or of the texts that are
    tagged at once.
    """
    kinds = [character_kinds(text, table) for text in texts]
    windows = [_cut(k) for k in kinds if len(k)]
    tags = len(KINDS) + 1
    if not windows:
        return [np.empty((tags, 0), np.float32) for _ in texts]
    every = np.concatenate(windows)
    core = np.empty((tags, len(every), CORE), np.float32)
    heads, tails = (np.empty((tags, len(every), 2 * MARGIN), np.float32) for _ in range(2))
    for at in range(0, len(every), WINDOWS_AT_ONCE):
        some = tagger.emissions(np.ascontiguousarray(every[at : at + WINDOWS_AT_ONCE].T)).transpose(1, 2, 0)
        here = slice(at, at + some.shape[1])
        core[:, here] = some[..., MARGIN:-MARGIN]
        heads[:, here] = some[..., : 2 * MARGIN]
        tails[:, here] = some[..., -2 * MARGIN :]
    starts = np.cumsum([0] + [len(w) for w in windows])
    onward = np.setdiff1d(np.arange(len(every)), starts)  # windows that go on a text
    inside = (np.arange(2 * MARGIN, dtype=np.float32) + 0.5) / (2 * MARGIN)
    both = inside * heads[:, onward] + (1 - inside) * tails[:, onward - 1]
    core[:, onward - 1, -MARGIN:] = both[..., :MARGIN]
    core[:, onward, :MARGIN] = both[..., MARGIN:]
    flat, found, first = core.reshape(tags, -1), [], 0
    for k in kinds:
        found.append(flat[:, first * CORE : first * CORE + len(k)])
        first += -(-len(k) // CORE)
    return found


def tag_texts(texts: list[str], tagger: Tagger, table: np.ndarray) -> list[np.ndarray]:
    """Tags of every character of every text."""
    return tagger.decode(joined_scores(texts, tagger, table))


def _added(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of a tag, spaces around them apart, that touch no base span and are of that kind."""
    if not tags.any():
        return []
    edges = np.nonzero(np.diff(tags, prepend=0, append=0))[0]
    found = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if not tags[start]:
            continue
        rank, part = int(tags[start]) - 1, text[start:end]
        start, end = start + len(part) - len(part.lstrip(" ")), end - len(part) + len(part.rstrip(" "))
        if not _form(rank, text[start:end]):
            continue
        if not any(s < end and start < e for s, _, e in base):
            found.append((start, rank, end))
    return found


def spans_of(texts: list[str], tagger: Tagger, table: np.ndarray) -> Iterator[tuple[list, list]]:
    """For each text its base spans, and all spans in order."""
    for text, tags in zip(texts, tag_texts(texts, tagger, table)):
        base = base_spans(text)
        yield base, sorted(base + _added(text, tags, base))


def _training_windows(text: str, doc: int, table: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Windows of a varied text that hold spans or other digits, and one anywhere."""
    text, spans = vary(text, doc)
    gold = np.zeros(len(text), np.uint8)
    for start, kind, end in reversed(spans):
        gold[start:end] = kind + 1
    kinds = character_kinds(text, table)
    random = np.random.default_rng(doc % (1 << 32))
    centres = [(start + end) // 2 for start, _, end in spans][: WINDOWS_PER_DOC - 2]
    centres += [match.start() for match in re.finditer("[0-9@]", text) if not gold[match.start()]][:1]
    centres.append(int(random.integers(0, len(text))) if text else 0)
    for centre in centres:
        start = centre - int(random.integers(8, TRAINING_WINDOW - 8))
        window = np.zeros((2, TRAINING_WINDOW), np.uint8)
        low, high = max(start, 0), min(start + TRAINING_WINDOW, len(text))
        window[0, low - start : high - start] = kinds[low:high]
        window[1, low - start : high - start] = gold[low:high]
        yield window[0].tobytes(), window[1].tobytes()


def _hash(text: str) -> Column:
    return F.xxhash64(F.col(text))


def train(docs: DataFrame, text: str = "text", training_docs: int = TRAINING_DOCS) -> Tagger:
    """Tagger fitted on windows of at most ``training_docs`` documents with digits or an
    at sign, by the smallest hashes of their text, held-out ones apart. Without any it
    tags nothing."""
    table = kinds_table()
    some = docs.where(F.col(text).rlike("[0-9]{4}|@|[0-9][.][0-9]")).select(_hash(text).alias("hash"))
    some = some.where(F.pmod("hash", F.lit(FOLDS)) != HELD_OUT)
    hashes = some.distinct().orderBy("hash").limit(training_docs)
    # A hash decides, so the second pass looks at no text but those that are chosen.
    chosen = docs.select(F.col(text).alias("text"), _hash(text).alias("hash")).join(F.broadcast(hashes), "hash")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (int(h), number, *window)
                for t, h in zip(batch["text"], batch["hash"])
                for number, window in enumerate(_training_windows(t, int(h), table))
            ]
            yield pd.DataFrame(rows, columns=["hash", "number", "kinds", "gold"])

    # At most training_docs * WINDOWS_PER_DOC rows, as copies of a text count once.
    rows = (
        chosen.select("text", "hash")
        .mapInPandas(windows, "hash long, number long, kinds binary, gold binary")
        .groupBy("hash", "number")
        .agg(F.min("kinds").alias("kinds"), F.min("gold").alias("gold"))
        .toPandas()
        .sort_values(["hash", "number"])
    )
    tagger = Tagger.new(N_CHARACTER_KINDS, len(KINDS) + 1, UNITS)
    both = [
        np.frombuffer(b"".join(map(bytes, rows[name])), np.uint8).reshape(-1, TRAINING_WINDOW).T
        for name in ("kinds", "gold")
    ]
    if not both[1].any():
        tagger.weights["bias"][0] = 1e6
    else:
        tagger.fit(both[0], both[1].astype(np.intp), TRAINING_STEPS, TRAINING_BATCH)
    return tagger


def held_out_counts(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """(kind, form, n_gold, n_found, n_right) on the held-out documents, varied.

    ``form`` is ``base`` for spans the patterns find in the varied text and ``added`` for
    others; only the latter say what the tagger is worth. Precision is n_right / n_found,
    recall n_right / n_gold, start and end both exact.
    """
    table = kinds_table()

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in _parts(batch["hash"], list(batch["text"])):
                varied = [vary(t, len(t)) for t in part]
                rows = []
                for (_, gold), (base, spans) in zip(varied, spans_of([t for t, _ in varied], tagger, table)):
                    sides = [set(gold) & set(base), set(base), set(gold) - set(base), set(spans) - set(base)]
                    for form, (right, got) in (("base", sides[:2]), ("added", sides[2:])):
                        rows += [(KINDS[s[1]], form, int(s in right), int(s in got), int(s in right & got)) for s in right | got]
                yield pd.DataFrame(rows, columns=["kind", "form", "n_gold", "n_found", "n_right"])

    held = docs.select(F.col(text).alias("text"), _hash(text).alias("hash")).where(
        F.col("text").isNotNull() & (F.pmod("hash", F.lit(FOLDS)) == HELD_OUT)
    )
    rows = held.mapInPandas(counted, "kind string, form string, n_gold long, n_found long, n_right long")
    return rows.groupBy("kind", "form").agg(*[F.sum(n).alias(n) for n in ("n_gold", "n_found", "n_right")])


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, rank, end) by start, then kind.

    One row for each row of ``docs``. Positions are code points of the whole text, end
    exclusive, rank a place in ``KINDS``. A null or empty text has no spans; repeated
    rows and null ids stay; an empty table gives no rows; other columns do not matter.
    The tagger is trained on ``docs`` unless one is given.
    """
    tagger = tagger or train(docs, text)
    table = kinds_table()

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for ids, part in _parts(batch["doc_id"], texts):
                both = list(spans_of(part, tagger, table))
                rows = [
                    [[{"start": s, "rank": r, "end": e} for s, r, e in spans] for spans in kind]
                    for kind in zip(*both)
                ]
                yield pd.DataFrame({"doc_id": ids, "base": rows[0], "spans": rows[1]})

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start:int,rank:int,end:int>>"
    return chosen.mapInPandas(found, f"doc_id {kind}, base {spans}, spans {spans}")


def _parts(ids: pd.Series, texts: list[str]) -> Iterator[tuple[pd.Series, list[str]]]:
    """A batch in parts of about as many characters as are tagged at once."""
    first, characters = 0, 0
    for at, text in enumerate(texts, 1):
        characters += len(text)
        if characters >= CHARACTERS_AT_ONCE or at == len(texts):
            yield ids.iloc[first:at].reset_index(drop=True), texts[first:at]
            first, characters = at, 0
