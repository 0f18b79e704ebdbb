"""An interactive page of the daily series: monthly bars by day, yearly bars by month."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame

from daystack.operators.charts import default_selection, month_view, year_months, year_spine

PAGE = """<!doctype html>
<html lang="en"><head><meta charset="utf-8"><title>%TITLE%</title>
<style>
body{font-family:sans-serif;margin:2rem}.bar{display:flex;align-items:center;height:1.4rem}
.bar span{width:7rem}.bar i{display:block;height:1rem;background:#69c;margin-right:.5rem}.bar.top i{background:#c63}
</style></head><body>
<h1>%TITLE%</h1>
<p>Year <select id="year"></select> Month <select id="month"></select></p>
<h2>Days</h2><div id="days"></div><h2>Months</h2><div id="months"></div>
<script>
const days = %ROWS%, spine = %SPINE%, months = %YEAR_MONTH_MAP%, first = %DEFAULT%;
const year = document.getElementById("year"), month = document.getElementById("month");
const fill = (box, names, pick) => { box.replaceChildren(...names.map(n => new Option(n, n, n === pick, n === pick))); };
function bars(id, rows) {
  const most = Math.max(1, ...rows.map(r => r.n || 0));
  document.getElementById(id).replaceChildren(...rows.map(r => {
    const row = document.createElement("div"), name = document.createElement("span"), bar = document.createElement("i");
    row.className = r.top ? "bar top" : "bar"; name.textContent = r.name; bar.style.width = 60 * (r.n || 0) / most + "%";
    row.append(name, bar, r.n == null ? "No data" : r.n.toLocaleString("en")); return row;
  }));
}
function draw() {
  bars("days", days.filter(d => d.month === month.value).map(d => ({name: d.date, n: d.n, top: d.top})));
  bars("months", spine.filter(m => m.year === +year.value).map(m => ({name: m.month, n: m.n, top: m.top})));
}
year.onchange = () => { fill(month, months[year.value], months[year.value][0]); draw(); };
month.onchange = draw;
fill(year, Object.keys(months), String(first.year)); fill(month, months[first.year], first.month); draw();
</script></body></html>
"""


def render(series: DataFrame, path: str, title: str = "Daily counts") -> None:
    """``series`` (date, pilgrim_count) has a row a day; what the page needs of it is computed here."""
    days = [{"date": str(r["date"]), "month": r["year_month"], "n": r["pilgrim_count"], "top": r["is_max"]} for r in month_view(series).orderBy("date").toLocalIterator()]
    spine = [{"year": r["year"], "month": r["year_month"], "n": r["month_max"], "top": r["is_max"]} for r in year_spine(series).orderBy("year_month").toLocalIterator()]
    months = {str(r["year"]): r["months"] for r in year_months(series).toLocalIterator()}
    first = default_selection(series).first()
    if first["month_tab_year"] is None:
        raise ValueError("the series is empty")
    values = {"%TITLE%": title, "%ROWS%": json.dumps(days), "%SPINE%": json.dumps(spine), "%YEAR_MONTH_MAP%": json.dumps(months), "%DEFAULT%": json.dumps({"year": first["month_tab_year"], "month": first["month_tab_month"]})}
    page = PAGE
    for name, value in values.items():
        page = page.replace(name, value.replace("</", "<\\/"))
    Path(path).write_text(page, encoding="utf-8")
