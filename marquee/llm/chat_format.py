"""Chat formatting by schema fingerprints.

Records of any layout (JSON texts: prompt and response, instruction, lists of messages,
one turn a record) become canonical turns, and turns become marked text with a loss mask.

A record's fingerprint is the hash of its nested field paths (``messages[].role``). The
paths select the declarative mapping: of those in ``MAPPINGS`` whose needed paths the
record all has, the one that needs most, the earlier one if two need as many. A mapping
is chosen once a fingerprint and task, so a record costs one walk and one look-up;
unknown further fields change the fingerprint, not the choice. A mapping is a tuple of
rules, each saying where turns are, where their role and text stand, and which role names
are other names of ``user`` and ``assistant``.

A template marks a turn as ``opens role says text closes``. In roles and texts the escape
sign is doubled, and put after the first character of everything that could be read as a
control string (the template's own and those of other templates), so an escaped text holds
no control string and ``unescape`` gives back every character.

A turn is formatted where it is read: a conversation is the concatenation of its rows'
segments in order and is never one cell, so its length is not bounded by a task's memory.
Reading back shuffles the segments by conversation once, and streams each conversation,
sorted, through its digests. SHA-256 has no parallel form, so one conversation's bytes do
pass through one task, but only one Arrow batch of them is held.

Defined cases: a null or absent text is empty, a null role is the empty role, numbers and
booleans are their JSON text; half a surrogate pair becomes U+FFFD; a record that is no
JSON object or that no mapping takes gives one row without turn (``mapping`` null), which
``rejects`` returns and formatting leaves out; a null id is an id like any other;
rows of equal place go by their formatted text, and repeated rows are turns each; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = "\\"
# Control strings of public chat templates.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>",
            "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<|start_header_id|>",
            "<|end_header_id|>", "<|eot_id|>", "<start_of_turn>", "<end_of_turn>")
# Other names of the canonical roles.
SPEAKERS = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
            "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Rule:
    """Turns at ``each`` (the record itself if empty): text from the scalars at the
    ``text`` paths, role fixed or at ``role_at``. ``glue`` goes between non-empty texts;
    an ``optional`` turn is left out if its text is missing, null or empty."""

    text: tuple[str, ...]
    role: str | None = None
    role_at: str | None = None
    each: str = ""
    glue: str = ""
    optional: bool = False
    names: dict = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Mapping:
    name: str
    needs: tuple[str, ...]
    rules: tuple[Rule, ...]


_MESSAGES = Rule(each="messages[]", role_at="role", text=("content", "content[].text"))
_SPOKEN = Rule(each="conversations[]", role_at="from", text=("value",), names=SPEAKERS)
_SYSTEM = Rule(role="system", text=("system",), optional=True)
_TASK = Rule(role="user", text=("instruction", "input"), glue="\n\n")


def _asked(question: str, answer: str) -> tuple[Mapping, ...]:
    """The pair of fields, and each of the two alone."""
    ask, reply = Rule(role="user", text=(question,)), Rule(role="assistant", text=(answer,))
    return (Mapping(f"{question}-{answer}", (question, answer), (_SYSTEM, ask, reply)),
            Mapping(question, (question,), (_SYSTEM, ask)), Mapping(answer, (answer,), (reply,)))


MAPPINGS = (
    Mapping("message-parts", ("messages[].role", "messages[].content[].text"), (_SYSTEM, _MESSAGES)),
    Mapping("messages", ("messages[].role", "messages[].content"), (_SYSTEM, _MESSAGES)),
    Mapping("speakers", ("conversations[].from", "conversations[].value"), (_SYSTEM, _SPOKEN)),
    Mapping("authored", ("message.author.role", "message.content.parts[]"),
            (Rule(role_at="message.author.role", text=("message.content.parts[]",)),)),
    Mapping("instruction-output", ("instruction", "output"),
            (_SYSTEM, _TASK, Rule(role="assistant", text=("output",)))),
    Mapping("instruction", ("instruction",), (_SYSTEM, _TASK)),
    Mapping("output", ("output",), (Rule(role="assistant", text=("output",)),)),
    *_asked("prompt", "completion"), *_asked("prompt", "response"), *_asked("question", "answer"),
    Mapping("turn", ("role", "text"), (Rule(role_at="role", text=("text",)),)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """The nested field paths of a record: ``.`` leads into an object, ``[]`` into a
    list. Signs of paths inside a field's name are escaped."""
    if isinstance(value, dict) and value:
        dot = prefix + "." if prefix else ""
        return set().union(*(field_paths(v, dot + re.sub(r"([\\.\[])", r"\\\1", k))
                             for k, v in value.items()))
    if isinstance(value, list):
        return set().union({prefix + "[]"} if not value else (),
                           *(field_paths(v, prefix + "[]") for v in value))
    return {prefix}


def fingerprint(paths: set[str]) -> str:
    """Hash of the set of field paths, as 16 hex digits."""
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "replace")).hexdigest()[:16]


def choose(paths: set[str], mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping | None:
    """The mapping whose needed paths are all there and that needs most of them."""
    fit = [m for m in mappings if paths.issuperset(m.needs)]
    return max(fit, key=lambda m: len(m.needs), default=None)


def _steps(path: str) -> list[str]:
    return [s for s in re.split(r"\.|(\[\])", path) if s]


def _at(value, steps: list[str]) -> list:
    """The values that a path leads to, in order."""
    if not steps:
        return [value]
    if steps[0] == "[]":
        return [x for v in value for x in _at(v, steps[1:])] if isinstance(value, list) else []
    return _at(value[steps[0]], steps[1:]) if isinstance(value, dict) and steps[0] in value else []


def _text(value) -> str:
    if value is None or isinstance(value, (dict, list)):
        return ""
    text = value if isinstance(value, str) else json.dumps(value)
    if not text.isascii():
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def turns_of(record, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) of a record's turns, by its mapping."""
    out = []
    for rule in mapping.rules:
        for item in _at(record, _steps(rule.each)):
            parts = ["".join(map(_text, _at(item, _steps(p)))) for p in rule.text]
            text = rule.glue.join(filter(None, parts))
            role = rule.role
            if role is None:
                role = "".join(map(_text, _at(item, _steps(rule.role_at))))
                role = rule.names.get(role, role)
            if text or not rule.optional:
                out.append((role, text))
    return out


class Template:
    """Markup of turns; see the module's description."""

    def __init__(self, opens="<|im_start|>", says="<|im_sep|>", closes="<|im_end|>",
                 controls=CONTROLS, loss_roles=("assistant",)):
        self.opens, self.says, self.closes = opens, says, closes
        self.loss_roles = frozenset(loss_roles)
        self.controls = tuple(dict.fromkeys((opens, says, closes, *controls)))
        for c in self.controls:
            # a control string that begins with its own end could be misread across a seam
            if len(c) < 2 or ESCAPE in c or any(c.startswith(c[i:]) for i in range(1, len(c))):
                raise ValueError(f"unfit control string {c!r}")
        self._risky = re.compile("|".join(
            [re.escape(ESCAPE), *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)]))
        opens, says, closes = map(re.escape, (opens, says, closes))
        self._turn = re.compile(f"{opens}(.*?){says}(.*?){closes}", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._risky.sub(lambda m: m.group() + ESCAPE, text)

    @staticmethod
    def unescape(text: str) -> str:
        # a control string's first character keeps its place before the sign that
        # follows it, a doubled sign is one: either way the next sign goes
        if ESCAPE not in text:
            return text
        return re.sub(r"\\(\\?)", r"\1", text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The marked turn, and the start and end of its text in it."""
        head, body = f"{self.opens}{self.escape(role)}{self.says}", self.escape(text)
        return f"{head}{body}{self.closes}", len(head), len(head) + len(body)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a formatted text."""
        out, at = [], 0
        while at < len(formatted):
            m = self._turn.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at character {at}")
            out.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        return out


REMEMBERED = 4096  # fingerprints a task remembers the mapping of


def canonical_turns(records: DataFrame, id_col: str, record_col: str, order_col: str,
                    mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Every turn of every record: ``id``, ``place`` (the record's ``order_col``), ``pos``
    in its record, ``role``, ``text``, ``fingerprint``, ``mapping``. A record without
    mapping has one row, without pos, role and text."""
    kinds = {f.name: f.dataType for f in records.select(id_col, order_col).schema}
    schema = T.StructType([T.StructField("id", kinds[id_col]), T.StructField("place", kinds[order_col])]
                          + [T.StructField(n, t) for n, t in (
                              ("pos", T.IntegerType()), ("role", T.StringType()), ("text", T.StringType()),
                              ("fingerprint", T.StringType()), ("mapping", T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Mapping | None] = {}
        for batch in batches:
            source, rows = [], []
            for i, text in enumerate(batch.column("record").to_pylist()):
                try:
                    record = json.loads(text or "")
                except (ValueError, RecursionError):
                    record = None
                print_, mapping = None, None
                if isinstance(record, dict):
                    paths = field_paths(record)
                    print_ = fingerprint(paths)
                    if print_ not in known:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[print_] = choose(paths, mappings)
                    mapping = known[print_]
                if mapping is None:
                    rows.append((None, None, None, print_, None))
                    source.append(i)
                    continue
                turns = turns_of(record, mapping)
                rows += [(k, role, said, print_, mapping.name) for k, (role, said) in enumerate(turns)]
                source += [i] * len(turns)
            pick = pa.array(source, pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pick), batch.column("place").take(pick),
                 pa.array(columns[0], pa.int32()), *(pa.array(c, pa.string()) for c in columns[1:])],
                names=schema.names)

    return records.select(records[id_col].alias("id"), records[order_col].alias("place"),
                          records[record_col].alias("record")).mapInArrow(run, schema)


def rejects(turns: DataFrame) -> DataFrame:
    """Records that no mapping takes: ``id``, ``place``, ``fingerprint``."""
    return turns.where("mapping IS NULL").select("id", "place", "fingerprint")


def layouts(turns: DataFrame) -> DataFrame:
    """Which mapping each fingerprint chose, and for how many turns."""
    return turns.groupBy("fingerprint", "mapping").agg(F.count("pos").alias("n_turns"))


def formatted_turns(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """The marked text of every turn: ``id``, ``place``, ``pos``, ``segment``, and where
    the loss mask lies in it (``loss_start``, ``loss_end``; null: nowhere)."""
    template = template or Template()
    schema = T.StructType([turns.schema["id"], turns.schema["place"], turns.schema["pos"]] + [
        T.StructField("segment", T.StringType()), T.StructField("loss_start", T.IntegerType()),
        T.StructField("loss_end", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                segment, start, end = template.turn(role or "", text or "")
                learnt = (role or "") in template.loss_roles
                texts.append(segment)
                starts.append(start if learnt else None)
                ends.append(end if learnt else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "place", "pos")), pa.array(texts, pa.string()),
                 pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=schema.names)

    return turns.where("mapping IS NOT NULL").select(
        "id", "place", "pos", "role", "text").mapInArrow(run, schema)


def read_back(segments: DataFrame, id_col: str, template: Template | None = None) -> DataFrame:
    """Per conversation, from its formatted text alone: id, ``n_turns``, ``turns_sha256``
    (role, newline, text, newline per turn), ``loss_chars`` and ``loss_sha256`` (the text
    under the loss mask, unescaped), ``formatted_chars``."""
    template = template or Template()
    schema = T.StructType([T.StructField(id_col, segments.schema["id"].dataType)] + [
        T.StructField(n, t) for n, t in (
            ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
            ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))])
    kind = pa.schema([(id_col, _arrow(segments.schema["id"].dataType)), ("n_turns", pa.int64()),
                      ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def closed():
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done = []
            for id_, segment, start, end in zip(*(batch.column(c).to_pylist() for c in (
                    "id", "segment", "loss_start", "loss_end"))):
                if state is None or id_ != now:
                    if state is not None:
                        done.append(closed())
                    now, state = id_, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in template.read(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learnt = template.unescape(segment[start:end])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(segment)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], f.type) for c, f in zip(closed(), kind)], schema=kind)

    return (segments.repartition("id").sortWithinPartitions("id", "place", "pos", "segment")
            .select("id", "segment", "loss_start", "loss_end").mapInArrow(run, schema))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


__all__ = ["MAPPINGS", "Mapping", "Rule", "Template", "canonical_turns", "fingerprint",
           "formatted_turns", "layouts", "read_back", "rejects"]
