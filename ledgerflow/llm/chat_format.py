"""Chat formatting: schema fingerprints choose declarative mappings to turns.

A layout (``Layout``) says where a record keeps its turns, as SQL over field
paths, and names the paths it needs and those it may do without.  A record's
fingerprint is the SHA-256 of its nested field paths, sorted; each layout is
registered under the fingerprints of its possible path sets, so choosing a
mapping is one lookup and no field is probed by guesswork.  Fingerprints are
taken of a table's schema for typed records (``canonical_turns``) and of every
single record for JSON text (``canonical_json``).

Canonical turns are formatted by a template that marks each turn; control
strings inside a text are escaped reversibly, and the loss mask is a list of
code point ranges of the formatted text.  Built-in functions throughout.

Defined cases: a null text or role is empty; turns are ordered by turn number
(null first), then role, then text, and repeated rows stay repeated; a record
without a known layout keeps its row with ``layout`` null and no turns; columns
a layout does not name are ignored, unless they would fit another layout too,
in which case the layout listed first wins.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<turn:bigint,role:string,text:string>"
START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Layout:
    """``turns``: SQL for an array of TURN, or, where a record is one turn of a
    conversation, for a single TURN (``by_turn``).  In ``from_json`` form the
    same SQL reads the record parsed with ``schema``."""

    name: str
    needs: tuple[str, ...]
    turns: str
    may: tuple[str, ...] = ()
    by_turn: bool = False
    schema: str = ""

    def fingerprints(self) -> list[str]:
        sets = (self.needs + extra for n in range(len(self.may) + 1) for extra in itertools.combinations(self.may, n))
        return [fingerprint(paths) for paths in sets]


def fingerprint(paths: tuple[str, ...] | list[str]) -> str:
    """SHA-256 of the sorted field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def _turn(number: str, role: str, text: str) -> str:
    return f"named_struct('turn', cast({number} as bigint), 'role', cast({role} as string), 'text', cast({text} as string))"


def _some(*turns: tuple[str, str, str]) -> str:
    """Turns of (condition, role, text) whose condition holds, numbered from 0."""
    made = ", ".join(f"if({when}, {_turn('0', role, text)}, null)" for when, role, text in turns)
    return f"transform(filter(array({made}), t -> t is not null), (t, i) -> {_turn('i', 't.role', 't.text')})"


def _speaker(field: str) -> str:
    return f"case lower({field}) when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant' when 'model' then 'assistant' else {field} end"


#: Known layouts, in order of precedence.
LAYOUTS = (
    Layout("turn_rows", ("conv_id", "turn", "role", "text"), _turn("turn", "role", "text"), by_turn=True),
    Layout("messages", ("messages[].role", "messages[].content"), f"transform(messages, (m, i) -> {_turn('i', 'm.role', 'm.content')})", schema="messages array<struct<role:string,content:string>>"),
    Layout("dialogue", ("conversations[].from", "conversations[].value"), f"transform(conversations, (m, i) -> {_turn('i', _speaker('m.from'), 'm.value')})", ("system",), schema="conversations array<struct<`from`:string,value:string>>, system string"),
    Layout("instruction", ("instruction", "output"), _some(("system is not null and system <> ''", "'system'", "system"), ("true", "'user'", "concat(coalesce(instruction, ''), if(coalesce(input, '') = '', '', concat('\\n\\n', input)))"), ("true", "'assistant'", "output")), ("input", "system"), schema="instruction string, input string, output string, system string"),
    Layout("prompt_completion", ("prompt", "completion"), _some(("true", "'user'", "prompt"), ("true", "'assistant'", "completion")), schema="prompt string, completion string"),
    Layout("prompt_response", ("prompt", "response"), _some(("system is not null and system <> ''", "'system'", "system"), ("true", "'user'", "prompt"), ("true", "'assistant'", "response")), ("system",), schema="prompt string, response string, system string"),
    Layout("question_answer", ("question", "answer"), _some(("coalesce(context, '') <> ''", "'system'", "context"), ("true", "'user'", "question"), ("true", "'assistant'", "answer")), ("context",), schema="question string, answer string, context string"),
)


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves of a type; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def choose(paths: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    """The layout registered under the fingerprint of those paths that any
    layout names (other columns do not take part); where the paths fit
    several layouts, the one listed first."""
    index = {f: layout for layout in reversed(layouts) for f in layout.fingerprints()}
    named = {p for layout in layouts for p in layout.needs + layout.may}
    found = index.get(fingerprint([p for p in paths if p in named]))
    if found is None:
        for layout in layouts:
            if index.get(fingerprint([p for p in paths if p in layout.needs + layout.may])) is layout:
                return layout
    return found


def _sorted_turns(turns: Column) -> Column:
    return F.array_sort(turns)


def canonical_turns(records: DataFrame, id_col: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Typed records to ``id_col, layout, turns``, by the schema's fingerprint."""
    layout = choose([p for p in schema_paths(records.schema) if p != id_col or id_col == "conv_id"], layouts)
    if layout is None:
        return records.select(id_col, F.lit(None).cast("string").alias("layout"), F.expr(f"cast(array() as array<{TURN}>)").alias("turns"))
    have = {p.split("[")[0].split(".")[0] for p in schema_paths(records.schema)}
    absent = [p for p in layout.may if p not in have]
    records = records.withColumns({p: F.lit(None).cast("string") for p in absent}) if absent else records
    name = F.lit(layout.name).alias("layout")
    if layout.by_turn:
        rows = records.select(id_col, F.expr(layout.turns).alias("t"))
        return rows.groupBy(id_col).agg(F.sort_array(F.collect_list("t")).alias("turns")).select(id_col, name, "turns")
    return records.select(id_col, name, F.coalesce(F.expr(layout.turns), F.expr(f"cast(array() as array<{TURN}>)")).alias("turns"))


def json_paths(text: Column) -> Column:
    """Sorted leaf paths of JSON records, to a depth of two: keys of the record,
    and of the first element of each of its arrays of records."""
    record = F.from_json(text, "map<string,string>")
    inner = F.transform(F.map_entries(record), lambda e: F.when(
        e["value"].startswith("[{"),
        F.transform(F.map_keys(F.from_json(F.get_json_object(e["value"], "$[0]"), "map<string,string>")), lambda k: F.concat(e["key"], F.lit("[]."), k)),
    ).otherwise(F.array(e["key"])))
    return F.array_sort(F.array_distinct(F.flatten(inner)))


def canonical_json(records: DataFrame, json_col: str, id_col: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """JSON records of any mix of layouts to ``id_col, layout, turns``; every
    record's own fingerprint selects its mapping.  Layouts by turn do not apply."""
    usable = [layout for layout in layouts if layout.schema]
    named = sorted({p for layout in usable for p in layout.needs + layout.may})
    index: dict[str, str] = {}
    for layout in reversed(usable):
        index |= dict.fromkeys(layout.fingerprints(), layout.name)
    known = F.array_intersect(json_paths(F.col(json_col)), F.lit(named) if named else F.array())
    prints = records.withColumn("_print", F.sha2(F.concat_ws("\n", known), 256))
    table = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in sorted(index.items())) + ")")
    named_rows = prints.withColumn("_layout", F.element_at(table, F.col("_print")))
    schema = ", ".join(dict.fromkeys(part.strip() for layout in usable for part in layout.schema.split(", ")))
    parsed = named_rows.select(F.col(id_col).alias("_id"), "_layout", F.from_json(F.col(json_col), schema).alias("_r")).select("_id", "_layout", "_r.*")
    turns = F.lit(None).cast(f"array<{TURN}>")
    for layout in usable:
        turns = F.when(F.col("_layout") == layout.name, F.expr(layout.turns)).otherwise(turns)
    return parsed.select(F.col("_id").alias(id_col), F.col("_layout").alias("layout"), F.coalesce(turns, F.expr(f"cast(array() as array<{TURN}>)")).alias("turns"))


def escape(text: str) -> str:
    """SQL: every ``<|`` gets a backslash between, as does every ``<\\..\\|``."""
    return f"regexp_replace({text}, r'<(\\\\*)\\|', r'<$1\\\\|')"


def unescape(text: str) -> str:
    return f"regexp_replace({text}, r'<\\\\(\\\\*)\\|', r'<$1|')"


def escape_role(role: str) -> str:
    """SQL: a role on one line, free of control strings."""
    return f"replace(replace(replace({role}, '~', '~0'), '\\n', '~1'), '|', '~2')"


def unescape_role(role: str) -> str:
    return f"replace(replace(replace({role}, '~2', '|'), '~1', '\\n'), '~0', '~')"


def format_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``id_col, layout, formatted, loss``: the text of each conversation by
    the template, and the code point ranges (start, end) of assistant texts."""
    made = F.expr(f"""transform(turns, t -> named_struct(
        'head', concat('{START}', {escape_role("coalesce(t.role, '')")}, '\\n'),
        'body', {escape("coalesce(t.text, '')")},
        'loss', coalesce(t.role, '') = 'assistant'))""")
    whole = F.expr(f"array_join(transform(made, p -> concat(p.head, p.body, '{END}\\n')), '')")
    # running length before each turn, in one pass over the turns
    sizes = F.expr(f"""transform(made, p -> named_struct('h', length(p.head), 'b', length(p.body), 'loss', p.loss))""")
    loss = F.expr(f"""aggregate(sizes, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>)),
        (s, p) -> named_struct('at', s.at + p.h + p.b + {len(END) + 1},
            'spans', if(p.loss, concat(s.spans, array(named_struct('start', s.at + p.h, 'end', s.at + p.h + p.b))), s.spans)),
        s -> s.spans)""")
    rows = turns.select(id_col, "layout", made.alias("made"))
    return rows.select(id_col, "layout", whole.alias("formatted"), sizes.alias("sizes")).select(id_col, "layout", "formatted", loss.alias("loss"))


def read_turns(formatted: str = "formatted") -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = f"filter(split({formatted}, r'<\\|im_start\\|>'), (p, i) -> i > 0)"
    cut = f"instr(p, '\\n')"
    return F.expr(f"""transform({pieces}, p -> named_struct(
        'role', {unescape_role(f"substring(p, 1, {cut} - 1)")},
        'text', {unescape(f"substring(p, {cut} + 1, length(p) - {cut} - {len(END) + 1})")}))""")


def read_loss(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, joined without anything between."""
    return F.expr(f"""array_join(transform({loss}, s -> {unescape(f"substring({formatted}, s.start + 1, s.end - s.start)")}), '')""")
