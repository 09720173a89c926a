"""Chat formatting: records of any known layout as canonical turns, and turns as training text with a loss mask.

A record is JSON. The nested field paths it holds, of those that any mapping names, are hashed; the hash selects a
declarative mapping, which says where roles and texts lie. Everything here is column expressions.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns of one conversation with these many successive turn numbers make one part of its text.
TURNS_PER_PART = 64

# The control strings of the template, and the strings that texts must not hold unescaped.
TURN_START, ROLE_END, TURN_END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"(?=/?s>|/?INST\])"
_ESCAPE, _UNESCAPE = r"([<\[])(\\*)" + _CONTROL, r"([<\[])\\(\\*)" + _CONTROL


@dataclass(frozen=True)
class Said:
    """A turn by a fixed role; its text is that of the paths, those that are there and not empty, parted by blank lines.
    Without any of the paths there is no such turn."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """A turn per element of an array."""

    array: str
    role: str
    text: str

    @property
    def paths(self) -> tuple[str, ...]:
        return f"{self.array}[].{self.role}", f"{self.array}[].{self.text}"


@dataclass(frozen=True)
class Own:
    """The record is one turn of its conversation, placed by the number at `turn`."""

    turn: str
    role: str
    text: str

    @property
    def paths(self) -> tuple[str, ...]:
        return self.turn, self.role, self.text


@dataclass(frozen=True)
class Mapping:
    """A layout: its turns in order, the paths it can do without, and other names of roles."""

    name: str
    turns: tuple[Said | Listed | Own, ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        return tuple(sorted({p for t in self.turns for p in t.paths}))

    def shapes(self) -> list[tuple[str, ...]]:
        """The sets of paths that this mapping reads: all its paths, less any of the optional ones."""
        left_out = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [tuple(p for p in self.paths if p not in gone) for gone in left_out]


_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("chatgpt", "assistant"))
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("turn_rows", (Own("turn", "role", "text"),)),
    Mapping("messages", (Said("system", ("system",)), Listed("messages", "role", "content")), ("system",), _NAMES),
    Mapping("from_value", (Said("system", ("system",)), Listed("conversations", "from", "value")), ("system",), _NAMES),
    Mapping(
        "instruction",
        (Said("system", ("system",)), Said("user", ("instruction", "input")), Said("assistant", ("output",))),
        ("system", "input"),
    ),
    Mapping(
        "prompt_response", (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("response",))), ("system",)
    ),
    Mapping(
        "prompt_completion", (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("completion",))), ("system",)
    ),
    Mapping(
        "question_answer",
        (Said("system", ("system",)), Said("user", ("context", "question")), Said("assistant", ("answer",))),
        ("system", "context"),
    ),
)


# --------------------------------------------------------------------------- records to turns


def _at(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, "$." + path, kind)


def _holds(record: Column, path: str) -> Column:
    """Whether a record has a path; a path with a JSON null is there."""
    array, _, inner = path.partition("[].")
    if not inner:
        return _at(record, path, "variant").isNotNull()
    return F.coalesce(F.exists(_at(record, array, "array<variant>"), lambda x: _at(x, inner, "variant").isNotNull()), F.lit(False))


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: Column, mappings: Sequence[Mapping] = MAPPINGS) -> Column:
    """The hash of the nested field paths of a record, in order; paths that no mapping names do not count."""
    known = sorted({p for m in mappings for p in m.paths})
    there = F.array(*[F.when(_holds(record, p), F.lit(p)) for p in known])
    return _hash(F.filter(there, lambda p: p.isNotNull()))


def _select(mark: Column, mappings: Sequence[Mapping], each) -> Column:
    """`each` of the mapping whose hash a record has; null for no mapping."""
    shapes: dict[tuple[str, ...], str] = {}
    found: Column | None = None
    for m in mappings:
        marks = []
        for shape in m.shapes():
            if shape in shapes:
                raise ValueError(f"mappings {shapes[shape]} and {m.name} read the same paths {shape}")
            shapes[shape] = m.name
            marks.append(mark == _hash(F.array(*[F.lit(p) for p in shape])))
        ours = marks[0]
        for other in marks[1:]:
            ours = ours | other
        found = F.when(ours, each(m)) if found is None else found.when(ours, each(m))
    return found if found is not None else F.lit(None)


def _turns(record: Column, mapping: Mapping) -> Column:
    """A record's turns under a mapping, as an array of (turn, role, text); the number is null but for rows by turn."""
    names = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair]) if mapping.roles else None

    def turn(role: Column, text: Column, number: Column | None = None) -> Column:
        named = F.coalesce(F.try_element_at(names, role), role) if names is not None else role
        return F.struct(
            (F.lit(None) if number is None else number).cast("long").alias("turn"),
            F.coalesce(named, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        )

    parts = []
    for t in mapping.turns:
        if isinstance(t, Said):
            texts = F.filter(F.array(*[_at(record, p, "string") for p in t.paths]), lambda x: F.length(x) > 0)
            there = _holds(record, t.paths[0])
            for p in t.paths[1:]:
                there = there | _holds(record, p)
            one = F.array(turn(F.lit(t.role), F.array_join(texts, "\n\n")))
            parts.append(F.when(there, one).otherwise(F.slice(one, 1, 0)))
        elif isinstance(t, Listed):
            role, text = t.role, t.text
            parts.append(
                F.transform(
                    _at(record, t.array, "array<variant>"), lambda x: turn(_at(x, role, "string"), _at(x, text, "string"))
                )
            )
        else:
            parts.append(F.array(turn(_at(record, t.role, "string"), _at(record, t.text, "string"), _at(record, t.turn, "long"))))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def mapped(records: DataFrame, payload: str = "payload", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """The columns of records as `row`, with fingerprint, mapping (its name) and turns.

    A record that is null, no JSON, or of a shape that no mapping reads has mapping and turns null; `unmapped` lists
    those shapes. A list without elements shows none of its paths, so such a record has no mapping either.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row")
    parsed = records.select(whole, F.try_parse_json(F.col(f"`{payload}`")).alias("record"))
    marked = parsed.withColumn("fingerprint", fingerprint(F.col("record"), mappings))
    chosen = _select(F.col("fingerprint"), mappings, lambda m: F.lit(m.name))
    turns = _select(F.col("fingerprint"), mappings, lambda m: _turns(F.col("record"), m))
    return marked.select("row", "fingerprint", chosen.alias("mapping"), turns.alias("turns"))


def canonical_turns(
    records: DataFrame, key: str = "conv_id", payload: str = "payload", mappings: Sequence[Mapping] = MAPPINGS
) -> DataFrame:
    """(conv_id, turn, role, text, mapping, fingerprint): a row per turn of the records that have a mapping.

    The turns of a list are numbered from 0; a record that is itself a turn brings its number. Null roles and texts are
    read as empty. Records with equal or null keys are the same conversation.
    """
    found = mapped(records, payload, mappings).select(
        F.col(f"row.`{key}`").alias("conv_id"), "mapping", "fingerprint", F.posexplode("turns").alias("at", "t")
    )
    number = F.coalesce("t.turn", F.when(F.col("mapping").isin(_numbered(mappings)), F.lit(None)).otherwise(F.col("at")))
    return found.select("conv_id", number.cast("long").alias("turn"), "t.role", "t.text", "mapping", "fingerprint")


def _numbered(mappings: Sequence[Mapping]) -> list[str]:
    return [m.name for m in mappings if any(isinstance(t, Own) for t in m.turns)]


def unmapped(records: DataFrame, payload: str = "payload", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """(fingerprint, shape, n_records) of what no mapping reads, so that a mapping can be declared for it."""
    shape = F.schema_of_variant(F.try_parse_json(F.col(f"row.`{payload}`"))).alias("shape")
    rest = mapped(records, payload, mappings).filter("mapping is null").select("fingerprint", shape)
    return rest.groupBy("fingerprint", "shape").agg(F.count(F.lit(1)).alias("n_records"))


def as_records(df: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """The rows of a table as records: the key, and all other columns as JSON with their nulls."""
    fields = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key])
    return df.select(F.col(f"`{key}`"), F.to_json(fields, {"ignoreNullFields": "false"}).alias(payload))


# --------------------------------------------------------------------------- turns to text and back


def escaped(text: Column) -> Column:
    """The text without control strings: each `<s>`, `</s>`, `[INST]` or `[/INST]` gets a backslash after its bracket.

    Backslashes that stand there already stay, so `unescaped` takes away exactly one and gives back any text.
    """
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def format_chats(turns: DataFrame, learned: str = "assistant", per_part: int = TURNS_PER_PART) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): the text of conversations, in parts that follow one another.

    A turn is `<s>[INST]role[/INST]text</s>` with control strings in role and text escaped. `loss` has the spans (start,
    length, in code points of the part's text) of the texts of the learned role, without the control strings around.

    Turns are in order of their number, null first, then of role and text. A part holds the turns of `per_part`
    successive numbers, so a conversation of any length is many rows and no task must hold it; null numbers are a part
    of their own. Repeated rows are turns of their own. No rows give no rows.
    """
    part = F.floor(F.col("turn") / per_part).cast("long").alias("part")
    one = F.struct("turn", "role", "text")
    gathered = turns.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(one)).alias("turns"))

    def clean(t: Column) -> Column:
        return F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"), (t["role"] == learned).alias("learned"))

    def span(done: Column, t: Column) -> Column:
        head = len(TURN_START) + F.length(t["role"]) + len(ROLE_END)
        own = F.array(F.struct((done["at"] + head).cast("int").alias("start"), F.length(t["text"]).alias("length")))
        spans = F.when(t["learned"], F.concat(done["spans"], own)).otherwise(done["spans"])
        return F.struct((done["at"] + head + F.length(t["text"]) + len(TURN_END)).cast("int").alias("at"), spans.alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    ready = gathered.select("conv_id", "part", F.transform("turns", clean).alias("turns"))
    pieces = F.transform(
        "turns", lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit(ROLE_END), t["text"], F.lit(TURN_END))
    )
    return ready.select(
        "conv_id", "part", F.size("turns").cast("long").alias("n_turns"), F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", none, span)["spans"].alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    pieces = F.split(formatted, TURN_END, -1)

    def back(piece: Column) -> Column:
        said = F.substring(piece, F.lit(len(TURN_START) + 1), F.length(piece))
        cut = F.instr(said, F.lit(ROLE_END))
        return F.struct(
            unescaped(F.substring(said, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substring(said, cut + len(ROLE_END), F.length(said))).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), back)


def learned_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped span by span, with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def digests(chats: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted parts: what its turns and the text under its mask are.

    A digest needs a conversation's whole text in one value, so here its parts meet in one row.
    """
    one = F.struct("part", "n_turns", "formatted", "loss")
    whole = chats.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("parts"))

    def said(p: Column) -> Column:
        return F.array_join(F.transform(turns_of(p["formatted"]), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")

    def total(each) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + each(p))

    read = whole.select(
        "conv_id",
        total(lambda p: F.size(F.split(p["formatted"], TURN_END, -1)).cast("long") - 1).alias("n_turns"),
        F.array_join(F.transform("parts", said), "").alias("said"),
        F.array_join(F.transform("parts", lambda p: learned_text(p["formatted"], p["loss"])), "").alias("learned"),
        total(lambda p: F.length(p["formatted"]).cast("long")).alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


#: The query's digests over plain text functions; only formatted_chars knows the template.
SQL = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<s>[INST]' || '[/INST]' || '</s>')
    + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1+\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1+\2\3', 'g'))) as bigint) as formatted_chars
from said group by conv_id
"""
