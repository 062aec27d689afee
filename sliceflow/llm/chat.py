"""Operator 7: chat formatting of typed content parts.

A message is a list of parts: text, image, audio, document. A visitor flattens
them, in order, into text with one placeholder for each attachment, and
records for every attachment its reference, where its placeholder stands and
how many tokens it expands to. The template marks turns; control strings
inside texts and roles are escaped, so a formatted conversation can be read
back without loss. A mask says which characters are trained on (what the
assistant says).

Formatting works row by row, one row per message. Only reading back needs the
rows of a conversation in order; it streams over sorted rows, so a conversation of
any length needs no more memory than a message.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import worker
#: the template: TURN role HEAD text END, for each turn
TURN, HEAD, END = "<|turn|>", "<|says|>", "<|end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: strings that no text may hold as they are
CONTROL = (TURN, HEAD, "<|end|>", *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|begin_of_text|>", "<|eot_id|>")
#: each of them begins with one of < and [, and has its escape after that
_CONTROL = re.compile("|".join(["\\\\", *map(re.escape, sorted(CONTROL, key=len, reverse=True))]))
_ESCAPED = re.compile(r"\\(.)", re.S)
#: pixels of a patch, tokens of a second, of a page
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256
TRAINED = "assistant"


def escape(text: str) -> str:
    """Control strings get a backslash after their first character, a backslash
    is doubled."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _size(part: dict, name: str, default: float) -> float:
    """A size that a part gives; the default if it is no number from 0 to 2^31."""
    x = part.get(name, default)
    return x if isinstance(x, (int, float)) and not isinstance(x, bool) and 0 <= x <= 1 << 31 else default


def _valid(text: str) -> str:
    """Text without lone surrogates, which JSON can hold and UTF-8 can't."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


class Flatten:
    """Visitor over the parts of a message: ``text`` is what they flatten to,
    ``attachments`` what it refers to. A part that is none of the known ones (another type,
    a number, a list) is the text of its JSON, null is nothing."""

    def __init__(self):
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[tuple[str, str, int, int]] = []

    @property
    def text(self) -> str:
        return "".join(self.out)

    def visit(self, part) -> None:
        kind = part.get("type") if isinstance(part, dict) else None
        if isinstance(kind, str) and kind in ("text", *PLACEHOLDERS):
            getattr(self, f"visit_{kind}")(part)
        elif part is not None:
            self.visit_text({"text": part})

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append((kind, _valid(str(part.get("ref", ""))), self.length, tokens))
        self._put(PLACEHOLDERS[kind])

    def visit_text(self, part: dict) -> None:
        text = part.get("text")
        text = "" if text is None else text if isinstance(text, str) else json.dumps(text, ensure_ascii=False)
        self._put(escape(_valid(text)))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil(_size(part, "width", PATCH) / PATCH) * math.ceil(_size(part, "height", PATCH) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(_size(part, "seconds", 0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, int(_size(part, "pages", 1)) * PAGE_TOKENS)


def message_parts(content: str | None) -> list:
    """The parts that a message's JSON lists; text that is no JSON is one part."""
    try:
        parts = json.loads(content) if content is not None else []
    except (ValueError, RecursionError):
        return [content]
    return parts if isinstance(parts, list) else [parts]


def format_message(role: str | None, parts: list) -> tuple[str, int, int, list]:
    """(segment, start and end of what is trained on, attachments with positions
    in the segment). Start and end are equal where nothing is."""
    visitor = Flatten()
    for p in parts:
        visitor.visit(p)
    head = TURN + escape(role or "") + HEAD
    text = visitor.text
    stop = len(head) + (len(text) if role == TRAINED else 0)
    return head + text + END, len(head), stop, [(k, ref, at + len(head), n) for k, ref, at, n in visitor.attachments]


def parse_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders stay in the text."""
    if not segment.startswith(TURN) or not segment.endswith(END) or HEAD not in segment:
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(TURN): -len(END)].partition(HEAD)
    return unescape(role), unescape(text)


_MESSAGE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()),
                      ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int64()), ("tokens", pa.int64())])))])


def _format(parts: bool):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                rows = []
                for conv, turn, role, content in zip(*(c.to_pylist() for c in b.slice(i, 512).columns)):
                    segment, start, stop, found = format_message(role, message_parts(content) if parts else [content])
                    rows.append((conv, turn, segment, start, stop, [dict(zip(("kind", "ref", "position", "tokens"), a)) for a in found]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _MESSAGE.types)], schema=_MESSAGE)
    return worker(run)


def format_messages(messages: DataFrame, content_col: str = "text", parts: bool = False) -> DataFrame:
    """One row per message: (conv_id, turn, segment, loss_start, loss_end,
    attachments: array of (kind, ref, position, tokens)). The segments of a
    conversation in order of turn are its formatted text.

    ``parts``: the content is JSON, a list of typed parts or one of them; else it
    is plain text. Null content has no parts, a null role is empty. Other
    columns are ignored.
    """
    kind = "conv_id long, turn long, segment string, loss_start long, loss_end long, attachments array<struct<kind:string,ref:string,position:long,tokens:long>>"
    return (messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col(content_col).cast("string"))
            .mapInArrow(_format(parts), kind))


_ROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                  ("formatted_chars", pa.int64())])


@worker
def _digest(batches):
    """Rows in order of conversation and turn -> one row per conversation."""
    held, key, out = None, None, []

    def close():
        if held:
            out.append((key, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4]))

    for b in batches:
        for i in range(0, b.num_rows, 512):
            for conv, segment, start, stop in zip(*(c.to_pylist() for c in b.slice(i, 512).columns)):
                if held is None or conv != key:
                    close()
                    held, key = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                role, text = parse_segment(segment)
                trained = unescape(segment[start:stop])
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                held[2] += len(trained)
                held[3].update(trained.encode("utf-8", "surrogatepass"))
                held[4] += len(segment)
            if len(out) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)
                out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted text: (conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars). Turns are in order
    of number, null first; equal numbers in order of segment. Rows with a null conv_id
    are one conversation."""
    return (formatted.select("conv_id", "turn", "segment", "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
            .select("conv_id", "segment", "loss_start", "loss_end")
            .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def op7_chat_formatting(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_messages(rows.unionByName(probe)))


ORACLE = """WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
 sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
 sum(23 + ESCAPED(role) + ESCAPED(text))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id""".replace("23", str(len(TURN + HEAD + END)))


def _escaped_length(column: str) -> str:
    controls = "|".join(re.escape(c).replace("'", "''") for c in sorted(CONTROL, key=len, reverse=True))
    return f"(length({column}) + len(regexp_extract_all({column}, '\\\\|{controls}')))"


ORACLE = ORACLE.replace("ESCAPED(role)", _escaped_length("role")).replace("ESCAPED(text)", _escaped_length("text"))
