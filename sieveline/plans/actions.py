"""Journal, to-do and deep-dive stages: what generating providers make of notes and take-aways."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.records import INVALID_ANSWERS
from sieveline.functions.text import refine, strip, truncate
from sieveline.operators import providers
from sieveline.operators.render import journal

#: What stands for nothing (fixed value).
NOTHING = "n/a"
#: Headers of a journal's sections, put before a section that does not name itself (fixed values).
INSIGHTS, TAKEAWAYS, ACTIONS, OVERALL = "Critical Insights", "Takeaways", "Action Items", "Overall:"


def _first_sentence(text: Column) -> Column:
    return strip(F.element_at(F.split(text, r"(?<=[.!?])\s+"), 1))


def numbered_lines(text: Column) -> Column:
    """Each line as an item of a numbered list."""
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")
    return F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), strip(x))), "\n")


@dataclass
class Agents:
    """The generating providers; the defaults are deterministic and need no network."""

    journal: providers.Provider = field(default_factory=lambda: refine)
    title: providers.Provider = field(default_factory=lambda: lambda text: truncate(_first_sentence(text), 40))
    insights: providers.Provider = field(default_factory=lambda: _first_sentence)
    takeaways: providers.Provider = field(default_factory=lambda: providers.lead_summary)
    todo: providers.Provider = field(default_factory=lambda: numbered_lines)
    summary: providers.Provider = field(default_factory=lambda: providers.lead_summary)
    translate: providers.Provider = field(default_factory=lambda: providers.same_language)
    collect: providers.Provider = field(default_factory=lambda: providers.lead_summary)
    write: providers.Provider = field(default_factory=lambda: providers.lead_summary)


def _section(header: str, text: Column) -> Column:
    return F.concat(F.when(text.contains(header), F.lit("")).otherwise(F.lit(f"{header}\n")), text)


def journal_page(notes: DataFrame, run_day: str, order: str, title: str, text: str, created: str, agents: Agents | None = None) -> DataFrame:
    """One row (name, source, last_created_time, text, translation, title, todo, translation_todo): the run's notes as a journal page.

    Notes are joined in order and rewritten; from the result come title, insights, take-aways, to-dos
    and a summary, each a section of the page. A run without notes has a page that says so.
    """
    day = notes.sparkSession.createDataFrame([(run_day,)], "name string")
    entry = journal(notes.withColumn("_day", F.lit(run_day)), "_day", order, title, text, created).select(F.col("_day").alias("name"), "entry", "last_created_time")
    return _pages(day.join(entry, "name", "left").withColumn("entry", F.coalesce("entry", F.lit(""))), agents or Agents())


def journal_pages(notes: DataFrame, day: str, order: str, title: str, text: str, created: str, agents: Agents | None = None) -> DataFrame:
    """A journal page, as of ``journal_page``, for each value of ``day``: the days of a journal, or of many people's, in one pass."""
    entries = journal(notes.where(F.col(day).isNotNull()), day, order, title, text, created)
    return _pages(entries.select(F.col(day).cast("string").alias("name"), "entry", "last_created_time"), agents or Agents())


def _pages(rows: DataFrame, a: Agents) -> DataFrame:
    rows = rows.withColumn("_r", a.journal(F.col("entry")))
    made = {"_title": a.title, "_insights": a.insights, "_takeaways": a.takeaways, "_todo": a.todo, "_summary": a.summary}
    rows = rows.withColumns({n: F.coalesce(p(F.col("_r")), F.lit("")) for n, p in made.items()})
    head = F.concat("name", F.lit(" "), "_title")
    parts = [head, F.col("_r"), _section(INSIGHTS, F.col("_insights")), _section(TAKEAWAYS, F.col("_takeaways")), _section(ACTIONS, F.col("_todo")), F.concat(F.lit(f"{OVERALL}\n"), "_summary")]
    rows = rows.withColumn("_text", F.concat_ws("\n\n", *parts))
    none = F.col("entry") == ""
    or_nothing = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(NOTHING))
    return rows.select(
        "name", F.lit("Journal").alias("source"), "last_created_time", F.when(none, "").otherwise(F.col("_text")).alias("text"),
        F.when(none, "").otherwise(a.translate(F.col("_text"))).alias("translation"), F.when(none, F.concat("name", F.lit(f" {NOTHING}"))).otherwise(head).alias("title"),
        F.when(none, NOTHING).otherwise(or_nothing(F.col("_todo"))).alias("todo"), F.when(none, NOTHING).otherwise(or_nothing(a.translate(F.col("_todo")))).alias("translation_todo"),
    )


def todo_pages(pages: DataFrame, journals: DataFrame | None = None, agents: Agents | None = None) -> DataFrame:
    """Pages with ``todo`` and ``translation_todo``, from their take-aways; journal pages from title and text.

    Take-aways of TODO and Journal sources and pages tagged for a deep dive are left out, and so are
    pages that the provider has no valid answer for.
    """
    a = agents or Agents()
    own = pages.where(F.length(F.coalesce("take_aways", F.lit(""))) > 0).withColumn("content", F.col("take_aways"))
    if journals is not None:
        title, text = (F.coalesce(c, F.lit("")) for c in ("title", "text"))
        own = own.unionByName(journals.withColumn("content", F.concat(title, F.lit(" "), text)), allowMissingColumns=True)
    own = own.where(~F.col("source").isin("TODO", "Journal") & ~F.coalesce(F.array_contains("tags", "action:deepdive"), F.lit(False)))
    made = own.withColumn("todo", a.todo(F.col("content"))).where(F.col("todo").isNotNull() & ~F.col("todo").isin(*INVALID_ANSWERS))
    return made.withColumn("translation_todo", a.translate(F.col("todo")))


def deepdive_pages(pages: DataFrame, iterations: int = 3, agents: Agents | None = None) -> DataFrame:
    """Pages tagged for a deep dive, with ``collection``, ``versions`` and ``deepdive`` (the last version) and its translation.

    The first article is written from the take-away and what was collected for it, each further one
    from the take-away, the article before and the collection.
    """
    a = agents or Agents()
    own = pages.where(F.array_contains("tags", "action:deepdive") & (F.length(F.coalesce("take_aways", F.lit(""))) > 0))
    rows = own.withColumn("collection", F.coalesce(a.collect(providers.prompt("collect", F.col("take_aways"))), F.lit("")))
    asked = lambda k: providers.prompt("deepdive", F.concat_ws("\n\n", "take_aways", *([f"_v{k - 1}"] if k > 1 else []), "collection"))
    for k in range(1, iterations + 1):
        rows = rows.withColumn(f"_v{k}", a.write(asked(k)))
    versions = [F.concat("take_aways", F.lit(f" (version {k})\n\n"), f"_v{k}") for k in range(1, iterations + 1)]
    rows = rows.withColumn("versions", F.array(*versions)).drop(*(f"_v{k}" for k in range(1, iterations + 1)))
    rows = rows.withColumn("deepdive", F.element_at("versions", -1))
    return rows.withColumn("translation_deepdive", a.translate(F.col("deepdive")))
