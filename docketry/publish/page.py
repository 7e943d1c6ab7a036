"""A published series as one HTML text: change tiles, a chart of each group, the months, the gates and the exceptions.

Only figures come in: a row for each month, gate and rule. The chart is drawn as SVG here, so the page needs no script;
the figures are also in it as JSON.
"""

from __future__ import annotations

import json
from html import escape

from pyspark.sql import DataFrame

WIDTH, HEIGHT, LEFT, FOOT = 720, 180, 48, 22
_STYLE = "body{font:15px system-ui;margin:2em auto;max-width:760px}table{border-collapse:collapse}td,th{padding:.2em .7em;text-align:left;border-bottom:1px solid #ccc}.tile{display:inline-block;margin-right:2em}.tile b{font-size:1.8em;display:block}.FAIL{color:#a00}.WARN{color:#a60}"


def chart(months: list[dict], group: str) -> str:
    """Counts of a group by month from zero up; settled months are joined and filled, preliminary ones hollow."""
    if not months:
        return ""
    top = max(1, *(m[group] for m in months))
    step = (WIDTH - LEFT - 10) / max(1, len(months) - 1)
    at = [(LEFT + i * step, HEIGHT - FOOT - (HEIGHT - FOOT - 10) * m[group] / top) for i, m in enumerate(months)]
    settled = [p for p, m in zip(at, months) if m["settled"]]
    dots = "".join(f'<circle cx="{x:.1f}" cy="{y:.1f}" r="3" stroke="#246" fill="{"#246" if m["settled"] else "#fff"}"><title>{m["month"]}: {m[group]}</title></circle>' for (x, y), m in zip(at, months))
    line = f'<polyline fill="none" stroke="#246" points="{" ".join(f"{x:.1f},{y:.1f}" for x, y in settled)}"/>' if settled else ""
    labels = f'<text x="0" y="14">{top:,}</text><text x="0" y="{HEIGHT - FOOT}">0</text><text x="{LEFT}" y="{HEIGHT - 4}">{months[0]["month"]}</text><text x="{WIDTH - 4}" y="{HEIGHT - 4}" text-anchor="end">{months[-1]["month"]}</text>'
    return f'<h2>{escape(group)}</h2><svg viewBox="0 0 {WIDTH} {HEIGHT}" width="100%" font-size="12" role="img" aria-label="{escape(group)} by month">{labels}{line}{dots}</svg>'


def _table(rows: list[dict]) -> str:
    if not rows:
        return "<p>none</p>"
    head = "".join(f"<th>{escape(c)}</th>" for c in rows[0])
    body = "".join(f'<tr class="{escape(str(r.get("status", "")))}">' + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r.values()) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def render(title: str, monthly: DataFrame, changes: dict[str, DataFrame], gates: DataFrame, exceptions: DataFrame, note: str = "") -> str:
    """HTML of the series ``monthly`` (month, a column for each group of ``changes``, settled) and its audit."""
    rows = lambda df: [{k: str(v) if k == "month" else v for k, v in r.asDict().items()} for r in df.collect()]
    months = rows(monthly.orderBy("month"))
    figures = {"months": months, "changes": {g: (rows(c) or [None])[0] for g, c in changes.items()}, "gates": rows(gates.orderBy("gate", "detail")), "exceptions": rows(exceptions)}
    tile = lambda g, c: f'<div class="tile">{escape(g)}, last 12 settled months<b>{c["last_12"]:,}</b>{c["pct_change"]:+.1f} % on the 12 before</div>' if c and c["pct_change"] is not None else ""
    tiles = "".join(tile(g, c) for g, c in figures["changes"].items())
    charts = "".join(chart(months, g) for g in changes)
    data = json.dumps(figures, default=str).replace("<", "\\u003c")
    return (
        f"<!doctype html><html lang=en><meta charset=utf-8><title>{escape(title)}</title><style>{_STYLE}</style><h1>{escape(title)}</h1><p>{escape(note)}</p>{tiles}{charts}"
        f"<details><summary>Months</summary>{_table(months)}</details><h2>Gates</h2>{_table(figures['gates'])}<h2>Exceptions</h2>{_table(figures['exceptions'])}"
        f'<script type="application/json" id="figures">{data}</script></html>'
    )
