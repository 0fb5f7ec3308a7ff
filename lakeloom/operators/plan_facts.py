"""What Spark's final plan of a query does, as rows."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

#: Parts of a plan's text.
_ID = re.compile(r"#\d+L?")
_NODE = re.compile(r"\((\d+)\)")


def executed(df: DataFrame) -> int:
    """Run the query on the executors, so that adaptive planning ends; its number of rows."""
    return df._jdf.queryExecution().toRdd().count()


def _formatted(df: DataFrame) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as said:
        df.explain("formatted")
    return said.getvalue()


def _listed(text: str) -> list[str]:
    """The members of ``[a, b(c, d)]``: commas inside brackets part nothing."""
    found, depth, one = [], 0, ""
    for c in text.strip()[1:-1]:
        depth += (c in "([<") - (c in ")]>")
        if c == "," and not depth:
            found.append(one.strip())
            one = ""
        else:
            one += c
    return [x for x in (*found, one.strip()) if x]


def plan_facts(df: DataFrame) -> list[tuple[str, str]]:
    """(kind, detail) for every step of interest in the final plan of ``df``, in the order of the plan.

    Kinds: ``column read`` and ``pushed filter`` (table: what), ``filter`` (a
    condition on rows that were read), ``exchange`` (by what rows are dealt out),
    ``join`` (strategy and type), ``python`` (a node that leaves the JVM).
    Run the query before (see ``executed``), or the plan isn't final.
    """
    text = _formatted(df)
    tree, _, rest = text.partition("\n\n")
    final = tree.partition("== Initial Plan ==")[0]
    steps = [int(m) for m in dict.fromkeys(_NODE.findall(final))]
    details = {}
    for block in re.split(r"\n(?=\(\d+\) )", rest):
        if m := re.match(r"\s*\((\d+)\) (.*)", block):
            details[int(m[1])] = (re.sub(r" \[codegen.*", "", m[2]).strip(), _ID.sub("", block))
    facts = []
    for step in steps:
        name, block = details.get(step, ("", ""))
        field = lambda key: m[1] if (m := re.search(rf"^{key}: (.*)$", block, re.M)) else ""
        if name.startswith("Scan"):
            table = re.sub(r"\.parquet$", "", (re.search(r"([^/\[\]]+)\]$", field("Location")) or ["", "?"])[1])
            facts += [("column read", f"{table}: {c.partition(':')[0]}") for c in _listed("<" + field("ReadSchema").partition("<")[2])]
            facts += [("pushed filter", f"{table}: {f}") for f in _listed(field("PushedFilters") or "[]")]
        elif name == "Filter":
            facts.append(("filter", field("Condition ")))
        elif name == "Exchange":
            dealt = field("Arguments")
            facts.append(("exchange", re.sub(r",? ?\d+\)$", ")", dealt[:dealt.index(")") + 1]) if ")" in dealt else dealt.partition(",")[0]))
        elif "Join" in name:
            kind = field("Join type")
            facts.append(("join", f"{name.split(' ')[0]} {kind}".strip()))
        elif re.search("Python|Pandas|Arrow", name):
            facts.append(("python", name))
    return facts
