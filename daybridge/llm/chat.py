"""Chat formatting: records of many layouts become canonical turns, then one marked text with a loss mask.

A record is a JSON text. Its fingerprint is the hash of its nested field paths (types of scalars
do not count), which selects a declarative layout: where the turns are, and who speaks. Nothing
else about a record is guessed; a fingerprint that no layout has gives no turns.

DataFrame functions alone: ``schema_of_variant`` lists the paths, ``variant_get`` follows them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.columns import let

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class TurnList:
    """Turns are the items of the list at ``path``, each with a field for the speaker and one for the text."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class TurnFields:
    """Each turn is a field of its own: (role, path) in the order of speaking. Absent, null and empty ones are no turns."""

    fields: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Layout:
    """A layout: required field paths (``a.b`` nested, ``a[].b`` in a list), optional ones, turns and other names of roles."""

    name: str
    required: tuple[str, ...]
    turns: TurnList | TurnFields
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


# Common layouts of public chat and instruction data sets, and their names of roles
# (in lists of messages the names are canonical already).
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
EXTRAS = ("id", "source")
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), TurnList("messages", "role", "content"), EXTRAS),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        TurnList("conversations", "from", "value"),
        EXTRAS,
        SPEAKERS,
    ),
    Layout("chat", ("data.turns[].speaker", "data.turns[].text"), TurnList("data.turns", "speaker", "text"), EXTRAS, SPEAKERS),
    Layout(
        "instruction",
        ("instruction", "output"),
        TurnFields((("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
        ("input", "system", *EXTRAS),
    ),
    Layout(
        "prompt",
        ("prompt", "response"),
        TurnFields((("system", "system"), ("user", "prompt"), ("assistant", "response"))),
        ("system", *EXTRAS),
    ),
    Layout(
        "question",
        ("question", "answer"),
        TurnFields((("user", "context"), ("user", "question"), ("assistant", "answer"))),
        ("context", *EXTRAS),
    ),
)

# Names of scalar types in the result of schema_of_variant.
_SCALARS = r"\b(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|BINARY|DATE|TIMESTAMP_NTZ|TIMESTAMP|VARIANT|DECIMAL\(\d+, ?\d+\))"


def canonical_schema(paths: tuple[str, ...]) -> str:
    """Nested field paths as one text, fields in sorted order: the form that ``record_schema`` gives."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def text(node: dict) -> str:
        if not node:
            return "_"
        named = []
        for name in sorted(node, key=lambda n: n.removesuffix("[]")):
            inner = text(node[name])
            named.append(f"{name.removesuffix('[]')}: " + (f"ARRAY<{inner}>" if name.endswith("[]") else inner))
        return f"OBJECT<{', '.join(named)}>"

    return text(tree)


def fingerprints(layout: Layout) -> list[str]:
    """Hashes of all forms of a layout: with and without each optional field, its list of turns empty or not."""
    found = []
    for n in range(len(layout.optional) + 1):
        for extra in combinations(layout.optional, n):
            found.append(canonical_schema((*layout.required, *extra)))
            if isinstance(layout.turns, TurnList):
                found.append(canonical_schema((layout.turns.path + "[]", *extra)))
    return [hashlib.sha256(f.encode()).hexdigest() for f in found]


def record_schema(record: Column) -> Column:
    """The nested field paths of a variant, scalar types left out."""
    return F.regexp_replace(F.schema_of_variant(record), _SCALARS, "_")


def _turns(record: Column, layout: Layout) -> Column:
    at = layout.turns
    if isinstance(at, TurnFields):
        read = lambda p: F.try_variant_get(record, f"$.{p}", "string")
        all_turns = F.array(*(F.struct(F.lit(r).alias("role"), read(p).alias("text")) for r, p in at.fields))
        return F.filter(all_turns, lambda t: F.length(t["text"]) > 0).cast(TURNS)
    items = F.try_variant_get(record, f"$.{at.path}", f"array<struct<`{at.role}`:string,`{at.text}`:string>>")
    known = F.create_map(*(F.lit(x) for pair in layout.roles.items() for x in pair)) if layout.roles else None

    def one(item: Column) -> Column:
        role = F.coalesce(item[at.role], F.lit(""))
        role = F.coalesce(F.try_element_at(known, role), role) if known is not None else role
        return F.struct(role.alias("role"), F.coalesce(item[at.text], F.lit("")).alias("text"))

    return F.coalesce(F.transform(items, one), F.array().cast(TURNS)).cast(TURNS)


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add fingerprint, layout (its name) and turns (array of role and text) to every record.

    A null record, one that is no JSON object, or one of an unknown layout has null layout and no
    turns. A null or absent text in a list of turns is an empty text. Columns of these three names
    are replaced; all others stay.
    """
    hashed = [(x, fingerprints(x)) for x in layouts]

    def read(v: Column) -> Column:
        print_ = F.sha2(record_schema(v), 256)

        def chosen(f: Column) -> Column:
            name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
            for layout, hashes in reversed(hashed):
                mine = f.isin(hashes)
                name, turns = F.when(mine, layout.name).otherwise(name), F.when(mine, _turns(v, layout)).otherwise(turns)
            return F.struct(f.alias("fingerprint"), name.alias("layout"), turns.alias("turns"))

        return let(print_, chosen)

    found = records.withColumn("__chat", let(F.try_parse_json(F.col(record_col).cast("string")), read))
    kept = [c for c in records.columns if c not in ("fingerprint", "layout", "turns")]
    return found.select(*(F.col(f"`{c}`") for c in kept), "__chat.fingerprint", "__chat.layout", "__chat.turns")


# --- template ------------------------------------------------------------------------------------

# Marks of this template, and control strings of others that texts must not hold either.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ANGLE = r"<(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)"
SQUARE = r"\[(?=INST\]|/INST\])"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """A text without control strings: their first sign, and the sign that marks an escape, become %XX."""
    text = F.replace(text, F.lit("%"), F.lit("%25"))
    return F.regexp_replace(F.regexp_replace(text, ANGLE, "%3C"), SQUARE, "%5B")


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``: every % of a text was made %25, so no other %3C or %5B can arise."""
    text = F.replace(F.replace(text, F.lit("%3C"), F.lit("<")), F.lit("%5B"), F.lit("["))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("%0A"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("%0A"), F.lit("\n")))


def format_chat(turns: Column) -> tuple[Column, Column]:
    """Formatted text of an array of turns, and its loss mask: spans (start, end) in code points, ends exclusive."""
    marked = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        ),
    )
    tail = f"{CLOSE}\n"
    text = F.array_join(F.transform(marked, lambda m: F.concat(m["head"], m["body"], F.lit(tail))), "")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, m: Column) -> Column:
        start = a["at"] + F.length(m["head"])
        end = start + F.length(m["body"])
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(m["loss"], F.concat(a["spans"], one)).otherwise(a["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    return text, F.aggregate(marked, begin, step, lambda a: a["spans"])


def format_records(
    records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """``canonical_turns`` with formatted (text) and loss_spans; a record without turns is an empty text."""
    found = canonical_turns(records, record_col, layouts)
    text, mask = format_chat(F.col("turns"))
    return found.withColumns({"formatted": text, "loss_spans": mask})


def read_chat(formatted: Column) -> Column:
    """Turns of a formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        whole,
        lambda p: F.struct(
            _unescaped_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
            unescaped(F.substr(p, F.position(F.lit("\n"), p) + 1)).alias("text"),
        ),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under a loss mask, unescaped."""
    read = lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(spans, read), "")


def conversation_records(turns: DataFrame) -> DataFrame:
    """(conv_id, record): conversations given as rows (conv_id, turn, role, text), as JSON of several layouts.

    Rows are ordered by turn, then role and text. A null role or text is empty; a row without
    conv_id is a conversation of its own. A user and an assistant turn give a prompt record, a
    system, a user and an assistant turn an instruction record (texts that are empty would be lost
    there: those and all others give lists of messages, of odd conversations in the names of the
    conversations layout).
    """
    own = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    row = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.groupBy("conv_id", own.alias("own")).agg(F.sort_array(F.collect_list(row)).alias("t"))
    text = lambda i: F.col("t")[i]["text"]
    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    full = F.forall("t", lambda x: F.length(x["text"]) > 0)
    as_list = lambda r, c: F.transform("t", lambda x: F.struct(x["role"].alias(r), x["text"].alias(c)))
    known = F.forall("t", lambda x: ~x["role"].isin(list(SPEAKERS)))
    names = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"))
    renamed = F.transform(
        "t",
        lambda x: F.struct(F.coalesce(F.try_element_at(names, x["role"]), x["role"]).alias("from"), x["text"].alias("value")),
    )
    record = (
        F.when(
            (roles == "user,assistant") & full,
            F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))),
        )
        .when(
            (roles == "system,user,assistant") & full,
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .when((F.col("conv_id") % 2 == 1) & known, F.to_json(F.struct(renamed.alias("conversations"))))
        .otherwise(F.to_json(F.struct(as_list("role", "content").alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))
