"""Chat formatting: records of many layouts become turns, and turns become text with a loss mask.

Everything here is DataFrame expressions and aggregates.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<turn: bigint, role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: the schema of its records, and SQL that turns such a record ``r`` into an array of turns."""

    name: str
    schema: T.StructType
    turns: str

    @property
    def paths(self) -> list[str]:
        return field_paths(self.schema)

    def apply(self, record: str) -> Column:
        return F.element_at(F.expr(f"transform(array({record}), r -> {self.turns})"), 1).cast(TURNS)


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _list_of(name: str, *parts: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.ArrayType(_texts(*parts)))])


def _pair(question: str, answer: str) -> str:
    return (
        f"array(struct(0L AS turn, 'user' AS role, {question} AS text), "
        f"struct(1L AS turn, 'assistant' AS role, {answer} AS text))"
    )


def _listed(field: str, role: str, text: str) -> str:
    named = f"CASE lower(m.{role}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.{role} END"
    return f"transform({field}, (m, i) -> struct(cast(i AS bigint) AS turn, {named} AS role, m.{text} AS text))"


MAPPINGS = (
    Mapping(
        "turn", T.StructType([T.StructField("turn", T.LongType()), *_texts("role", "text").fields]),
        "array(struct(r.turn, r.role, r.text))",
    ),
    Mapping("prompt_response", _texts("prompt", "response"), _pair("r.prompt", "r.response")),
    Mapping("prompt_completion", _texts("prompt", "completion"), _pair("r.prompt", "r.completion")),
    Mapping("question_answer", _texts("question", "answer"), _pair("r.question", "r.answer")),
    Mapping("instruction", _texts("instruction", "output"), _pair("r.instruction", "r.output")),
    Mapping(
        "instruction_input", _texts("instruction", "input", "output"),
        _pair("concat_ws('\\n\\n', r.instruction, nullif(r.input, ''))", "r.output"),
    ),
    Mapping("messages", _list_of("messages", "role", "content"), _listed("r.messages", "role", "content")),
    Mapping("conversations", _list_of("conversations", "from", "value"), _listed("r.conversations", "from", "value")),
)


# -- fingerprints


def field_paths(schema: T.DataType, at: str = "") -> list[str]:
    """The paths of all fields, nested ones included; ``[]`` stands for the elements of an array."""
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{at}[]")
    if not isinstance(schema, T.StructType):
        return []
    named = [(f"{at}.{f.name}" if at else f.name, f.dataType) for f in schema.fields]
    return sorted(path for name, kind in named for path in [name, *field_paths(kind, name)])


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


KNOWN_PATHS = sorted({path for m in MAPPINGS for path in m.paths})
BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}
_LISTS = sorted({path.split("[]")[0] for path in KNOWN_PATHS if "[]" in path})
_NO_TEXT = "array<string>"


def record_fingerprint(record: Column) -> Column:
    """Fingerprint of a JSON record: the hash of those of its nested field paths that a layout names."""

    def below(name: str) -> Column:
        items = F.from_json(F.get_json_object(record, f"$.{name}"), "array<string>")
        keys = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), F.array().cast(_NO_TEXT))))
        paths = F.transform(keys, lambda key: F.concat(F.lit(f"{name}[]."), key))
        return F.coalesce(paths, F.array().cast(_NO_TEXT))

    paths = F.concat(F.json_object_keys(record), *[below(name) for name in _LISTS])
    known = F.array_sort(F.array_distinct(F.filter(paths, lambda p: p.isin(KNOWN_PATHS))))
    return F.sha2(F.array_join(known, "\n"), 256)


# -- canonical turns


def table_turns(rows: DataFrame, id_column: str) -> DataFrame:
    """``(id, turn, role, text)`` of a table whose columns are one of the layouts.

    The layout is chosen by the fingerprint of the schema. Columns that no layout names do not count;
    a table of no known layout raises. A row whose record holds no turns gives none.
    """
    fields = [f for f in rows.schema.fields if f.name != id_column]
    named = [path for path in field_paths(T.StructType(fields)) if path in KNOWN_PATHS]
    mapping = BY_FINGERPRINT.get(fingerprint(named))
    if mapping is None:
        raise ValueError(f"no layout has the fields {named}")
    record = f"struct({', '.join(mapping.schema.fieldNames())})"
    return rows.select(F.col(id_column).alias("id"), mapping.apply(record).alias("turns")).select("id", F.inline("turns"))


def record_turns(rows: DataFrame, id_column: str, record: str) -> DataFrame:
    """``(id, layout, turns)`` of JSON records, each turned by the layout that its own fingerprint chooses.

    The layout and the turns are null where the record is null or no object, or has the fields of no
    layout or of several. Fields that no layout names do not count.
    """
    hashed = rows.select(F.col(id_column).alias("id"), F.col(record).alias("record")).withColumn(
        "fingerprint", record_fingerprint(F.col("record"))
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for digest, mapping in BY_FINGERPRINT.items():
        chosen = F.col("fingerprint") == digest
        layout = F.when(chosen, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(chosen, mapping.apply(f"from_json(record, '{mapping.schema.simpleString()}')")).otherwise(turns)
    return hashed.select("id", layout.alias("layout"), turns.alias("turns"))


# -- template

# What the template itself writes.
TURN_MARK, TEXT_MARK, END_MARK = "<|turn|>", "<|text|>", "<|end|>"
# Strings that chat models read as control. They never stand unbroken inside a text.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")

# The first character of each control string, and the escape character itself.
_ESCAPED = r"\\|<(?=\||/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Text with a backslash after the first character of each control string and after each backslash."""
    return F.regexp_replace(text, _ESCAPED, r"$0\\")


def unescape(text: Column) -> Column:
    """Undo ``escape``: of two backslashes one stays, and one that stands alone goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(id, formatted, pieces)`` per conversation from rows ``(id, turn, role, text)``.

    ``pieces`` is the loss mask: the formatted text in order, as an array of texts, each flagged whether
    it counts in the loss; just the texts of assistant turns do, without the marks around them. Turns
    are ordered by number, then role, then text, nulls first, so repeated turns stay and order is
    defined; a null role or text is empty; null ids form a conversation; no rows give no rows.
    A conversation is one value of the result, so it has to fit in a row; conversations share nothing.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    gathered = turns.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns")
    )

    def piece(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    plain = F.lit(False)
    pieces = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                piece(F.concat(F.lit(TURN_MARK), escape(t["role"]), F.lit(TEXT_MARK)), plain),
                piece(escape(t["text"]), t["role"] == "assistant"),
                piece(F.lit(END_MARK), plain),
            ),
        )
    )
    found = gathered.select("id", pieces.alias("pieces"))
    return found.select("id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces")


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted text as an array of roles and texts."""
    marked = F.split(formatted, r"<\|end\|>", -1)
    whole = F.slice(marked, 1, F.size(marked) - 1)  # what follows the last mark is empty
    halves = F.transform(whole, lambda t: F.split(F.substring(t, len(TURN_MARK) + 1, 2**31 - 1), r"<\|text\|>", 2))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def chat_digests(chats: DataFrame) -> DataFrame:
    """Counts and hashes read back from formatted text and loss mask."""
    read = chats.select(
        F.col("id").alias("conv_id"), parse_chats(F.col("formatted")).alias("turns"),
        loss_text(F.col("pieces")).alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def _sql() -> str:
    texts = ["coalesce(role, '')", "coalesce(text, '')"]
    extra = " + ".join(
        f"(length({t}) - length(replace({t}, '{c}', ''))) // {len(c)}" for t in texts for c in ("\\", *CONTROL)
    )
    marks = len(TURN_MARK + TEXT_MARK + END_MARK)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({marks} + length(role) + length(text) + {extra}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


# What chat_digests returns for the conversations table and conversation -1, as DuckDB SQL.
SQL = _sql()
