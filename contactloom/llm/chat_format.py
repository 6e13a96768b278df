r"""Chat formatting: turns of typed content parts as marked text, with a loss mask, readable back without loss.

A turn is written `### role:\n`, its content, `</turn>\n`. A visitor walks the content's parts (text, image, audio,
document; a plain string is one text part): text is escaped, the others become numbered placeholders in order, and
what they stand for is recorded with the tokens that it expands to. A backslash goes before every character that would
start a control string, and before backslashes; `read_turn` undoes it. The loss mask covers the content of assistant
turns.

The output is one segment a turn; a conversation is its segments in order. Reading back streams over sorted segments
and holds one running digest, so a very long conversation needs no more memory than a short one.

Edge cases: null text is empty; a null role is an empty one; a conv_id is any text, null ones are one conversation; equal turn numbers go
by role, then text; parts of an unknown type raise an error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.packing import tokenizer_at

ESCAPED = re.compile(r"\\|#(?=##)|<(?=/turn>|image |audio |document )")
ROLE_ESCAPED = re.compile(r"[\\:\n#<]")
#: Possessive, so that no state is kept for the characters of a long turn.
TURN = re.compile(r"### ((?:[^\\:\n]++|\\.)*+):\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
UNESCAPE = re.compile(r"\\(.)", re.S)
#: Tokens of one image tile, of a second of audio, of a page of a document.
TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 256, 25, 512
SEGMENT = (
    "conv_id string, turn long, role string, text string, segment string, mask_start long, mask_end long, "
    "tokens long, attachments array<struct<place:long,kind:string,ref:string,tokens:long>>"
)


def count_words(text: str) -> int:
    return len(text.split())


@dataclass
class PartVisitor:
    """Walks content parts; `out` holds the pieces of the turn's text. `count` tells how many tokens a text has."""

    count: Callable[[str], int] = count_words
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type")
        method = getattr(self, f"visit_{kind}", None) if isinstance(kind, str) else None
        if method is None:
            raise ValueError(f"unknown content part: {kind!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.tokens += self.count(text)
        self.out.append(ESCAPED.sub(r"\\\g<0>", text))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        place = len(self.attachments) + 1
        self.tokens += tokens
        self.attachments.append({"place": place, "kind": kind, "ref": str(part.get("ref") or ""), "tokens": tokens})
        self.out.append(f"<{kind} {place}>")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, TILE_TOKENS * max(1, int(part.get("tiles") or 1)))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, round(SECOND_TOKENS * float(part.get("seconds") or 0))))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, PAGE_TOKENS * max(1, int(part.get("pages") or 1)))


def write_turn(role: str, content: str | list[dict], count: Callable[[str], int] = count_words) -> tuple[str, int, int, int, list[dict]]:
    """(segment, mask start, mask end, tokens, attachments); the mask is empty but for assistant turns."""
    visitor = PartVisitor(count)
    for part in [{"type": "text", "text": content}] if isinstance(content, str) else content:
        visitor.visit(part)
    head, body = f"### {ROLE_ESCAPED.sub(r'\\\g<0>', role)}:\n", "".join(visitor.out)
    start = len(head)
    return f"{head}{body}</turn>\n", start, start + len(body) * (role == "assistant"), visitor.tokens, visitor.attachments


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def read_turn(segment: str) -> tuple[str, str]:
    """(role, content) of a segment; placeholders stay as they are."""
    m = TURN.fullmatch(segment)
    if m is None:
        raise ValueError("not one whole turn")
    return unescape(m[1]), unescape(m[2])


def read_all(text: str) -> list[tuple[str, str]]:
    """All turns of a whole formatted conversation."""
    out, at = [], 0
    while at < len(text):
        m = TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def format_turns(turns: DataFrame, parts: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """One segment a row of turns (conv_id, turn, role, text); `parts` names a column of JSON lists of content parts.

    Where it is null, the text is used. `tokenizer` is the path of a tokenizer's file, by which text is counted (by words
    without one).
    """
    content = F.col(parts) if parts else F.lit(None).cast("string")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        content.alias("parts"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = count_words if tokenizer is None else lambda t: len(tokenizer_at(tokenizer).encode(t, add_special_tokens=False).ids)
        for f in frames:
            made = [write_turn(r, json.loads(p) if isinstance(p, str) else t, count) for r, t, p in zip(f["role"], f["text"], f["parts"], strict=True)]
            f = f.drop(columns="parts")
            for i, c in enumerate(("segment", "mask_start", "mask_end", "tokens", "attachments")):
                f[c] = [x[i] for x in made]
            f["turn"] = f["turn"].astype("Int64")
            yield f

    return rows.mapInPandas(run, SEGMENT)


class _Reader:
    """Digest of one conversation, fed by segments."""

    def __init__(self, conv_id: str | None):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, start: int, end: int) -> None:
        role, text = read_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        under = unescape(segment[start:end])
        self.loss += len(under)
        self.masked.update(under.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """One row a conversation, from its segments only."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Reader | None = None
        for f in frames:
            rows = []
            for conv, segment, a, b in zip(f["conv_id"], f["segment"], f["mask_start"], f["mask_end"], strict=True):
                conv = None if conv is None or conv != conv else conv
                if now is None or now.conv_id != conv:
                    if now is not None:
                        rows.append(now.row())
                    now = _Reader(conv)
                now.feed(segment, int(a), int(b))
            out = pd.DataFrame(rows, columns=names)
            yield out
        if now is not None:
            yield pd.DataFrame([now.row()], columns=names)

    order = segments.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return order.select("conv_id", "segment", "mask_start", "mask_end").mapInPandas(
        run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


#: A conversation of control strings, which every formatting has to survive.
PROBE = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all conversations and the probe, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(rows.unionByName(probe))).withColumn("conv_id", F.col("conv_id").cast("long"))
