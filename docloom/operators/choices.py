"""Free-form replies resolved to choices, in built-in expressions.

A reply that abstains is taken first. A list in it decides alone, if it can be read; only a reply without one is searched:
for a JSON object or string, for the reply as a whole, for the first choice it mentions, then for the first mention of a
part before a colon that only one choice has.
"""
from pyspark.sql import Column, functions as F

# Fixed value: the choice that means no answer.
UNKNOWN = "Unknown from this paper"
STRINGS = "array<string>"
ITEM = r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|-?[0-9]+(?:\.[0-9]+)?)"""
FENCED = r"""(?s)```json\s*(\{.*?\}|".*?")\s*```"""


def strip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def fold(s: Column) -> Column:
    """Lower case in which ß equals ss."""
    return F.replace(F.lower(s), F.lit("ß"), F.lit("ss"))


def _only(items: Column) -> Column:
    """The one item of an array, else null."""
    return F.when(F.size(items) == 1, F.try_element_at(items, F.lit(1)))


def _first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def base(choice: Column) -> Column:
    return F.split_part(choice, F.lit(":"), F.lit(1))


def normalize(choices: Column) -> Column:
    """array of (id, label) of an array of strings, which are JSON objects if the first is one; a missing label is the id."""
    obj = F.transform(choices, lambda x: F.from_json(x, "id string, label string"))
    pairs = F.transform(obj, lambda o: F.struct(F.coalesce(o["id"], F.lit("None")).alias("id"), F.coalesce(o["label"], o["id"], F.lit("None")).alias("label")))
    plain = F.transform(choices, lambda x: F.struct(x.alias("id"), x.alias("label")))
    return F.when(F.size(choices) > 0, F.when(_first(choices).rlike(r"^\s*\{"), pairs).otherwise(plain))


def labels(ids: Column, choices: Column) -> Column:
    """The label of each id; choices as normalize() gives them."""
    return F.transform(ids, lambda i: _first(F.filter(choices, lambda c: c["id"] == i))["label"])


def resolve(candidate: Column, ids: Column) -> Column:
    """The choice that an item of a list names: exactly, in another case, by the only matching part before a colon, as the only one's beginning, or as a letter by position; else null."""
    r = strip(candidate)
    low = fold(r)
    exact = _first(F.filter(ids, lambda x: x == r))
    other_case = _first(F.filter(ids, lambda x: fold(x) == low))
    by_base = F.when(~r.contains(":"), _only(F.filter(ids, lambda x: fold(base(x)) == low)))
    prefix = _only(F.filter(ids, lambda x: F.startswith(fold(x), low)))
    letter = F.when(r.rlike("^[A-Za-z]$"), F.try_element_at(ids, F.ascii(F.upper(r)) - 64))
    return F.when(r != "", F.coalesce(exact, other_case, by_base, prefix, letter))


def listed(reply: Column) -> Column:
    """Items of the list from a reply's first [ to the next ], in either kind of quotes, or of the key answers of a JSON reply; null where none can be read."""
    cut = F.regexp_extract(reply, r"\[[^\]]*\]", 0)
    readable = cut.rlike(rf"^\[\s*(?:{ITEM}\s*(?:,\s*{ITEM}\s*)*,?\s*)?\]$")
    bare = lambda x: F.when(x.rlike("^[\"']"), F.regexp_replace(x.substr(F.lit(2), F.length(x) - 2), r"\\(.)", "$1")).otherwise(x)
    items = F.transform(F.regexp_extract_all(cut, F.lit(ITEM), F.lit(0)), bare)
    keyed = F.when(reply.rlike(r"^\s*\{"), F.from_json(reply, f"answers {STRINGS}")["answers"])
    return F.coalesce(keyed, F.when(readable, items))


def resolve_many(candidates: Column, ids: Column) -> Column:
    """Distinct choices in the order of the candidates."""
    return F.array_distinct(F.filter(F.transform(candidates, lambda x: resolve(x, ids)), lambda x: x.isNotNull()))


def is_abstention(reply: Column) -> Column:
    return fold(F.regexp_replace(strip(reply), r"\.+$", "")) == UNKNOWN.lower()


def mentioned(reply: Column, ids: Column) -> Column:
    """The choice that prose mentions first as a whole word, the longest of those that begin there; else null."""
    quoted = lambda x: F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    at = lambda x: F.regexp_instr(reply, F.concat(F.lit("(?<![A-Za-z0-9_])"), quoted(x), F.lit("(?![A-Za-z0-9_])")))
    found = F.filter(F.transform(ids, lambda x: F.struct(at(x).alias("at"), (-F.length(x)).alias("n"), x.alias("id"))), lambda x: x["at"] > 0)
    return _first(F.array_sort(found))["id"]


def extract(reply: Column, ids: Column) -> Column:
    """The choice that a reply without a list names: in fenced JSON, as JSON, as the whole reply, or in prose; else null."""
    r = strip(reply)
    held = lambda x: F.when(F.array_contains(ids, x), x)
    json = lambda j: held(F.when(j.startswith("{"), F.get_json_object(j, "$.id")).when(j.startswith('"'), _first(F.from_json(F.concat(F.lit("["), j, F.lit("]")), STRINGS))))
    return F.when(r != "", F.coalesce(json(F.regexp_extract(r, FENCED, 1)), json(r), held(r), mentioned(r, ids)))


def extract_base(reply: Column, ids: Column) -> Column:
    """As extract, by the parts before a colon that one choice only has."""
    bases = F.transform(ids, lambda x: strip(base(x)))
    alone = F.filter(bases, lambda b: (b != "") & (F.size(F.filter(bases, lambda c: c == b)) == 1))
    name = extract(reply, alone)
    return _first(F.filter(ids, lambda x: strip(base(x)) == name))


def answer(reply: Column, ids: Column) -> Column:
    """struct(kind, ids): choices, abstain or, for a null reply, error; an open question (null ids) gives open."""
    none = F.array().cast(STRINGS)
    items, one = listed(reply), F.coalesce(extract(reply, ids), extract_base(reply, ids))
    got = F.when(is_abstention(reply), none).when(items.isNotNull(), resolve_many(items, ids)).when(one.isNotNull(), F.array(one)).otherwise(none)
    kind = F.when(reply.isNull(), "error").when(ids.isNull(), "open").when(F.size(got) > 0, "choices").otherwise("abstain")
    return F.struct(kind.alias("kind"), F.when(ids.isNotNull() & reply.isNotNull(), got).alias("ids"))
