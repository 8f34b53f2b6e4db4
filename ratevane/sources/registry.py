"""All sources of pages by name, what their ids may be stored under, and their rows over one table of pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import Pages
from . import providers, providers_more  # noqa: F401  each source puts itself into SOURCES
from .priced import PRICED, READINGS, SOURCES, c, lit

#: Page ids and the id that each is stored under as well.
SPELLINGS: dict[str, dict[str, str]] = {
    "databricks": {"deepseek-v4-pro": "deepseek-v4-pro-0813", "deepseek-v4-flash": "deepseek-v4-flash-0731"},
    "google": {"gemini-3.1-flash-image": "gemini-3.1-flash-image-preview", "gemini-3-pro-image": "gemini-3-pro-image-preview"},
    "novita": {"deepseek/deepseek-r1-0528": "deepseek/deepseek-r1", "deepseek/deepseek-v3-0324": "deepseek/deepseek_v3"},
    "scaleway": {"deepseek-v4-flash-0731": "deepseek-v4-flash", "mistral-small-3.2-24b-instruct-2506": "mistral-small-3.2-24b-instruct"},
    "together": {"llama-3.3-70b": "meta-llama/Llama-3.3-70B-Instruct-Turbo", "llama-3-8b-instruct-lite": "meta-llama/Meta-Llama-3-8B-Instruct-Lite"},
}
#: Previews of the source google, dated or not, and the ids of what they preview.
PREVIEWS = {"gemini-2.5-flash-native-audio-preview": "gemini-live-2.5-flash", "gemini-2.5-flash-lite-preview": "gemini-2.5-flash-lite"}


def _numeric(part: Column, digits: int = 0) -> Column:
    return part.rlike("^[0-9]+$") & ((F.length(part) == digits) if digits else lit(True))


def _dated_stem(parts: Column) -> Column:
    """Parts of an id that ends in a two-digit year and month: those before, less up to three whole numbers at their end, and the date as one part; else null."""
    n = F.size(parts)
    year, month = F.get(parts, n - 2), F.get(parts, n - 1)
    stem = F.slice(parts, 1, F.greatest(n - 2, lit(0)))
    for _ in range(3):
        stem = F.when((F.size(stem) > 1) & _numeric(F.get(stem, F.size(stem) - 1)), F.slice(stem, 1, F.size(stem) - 1)).otherwise(stem)
    return F.when((n > 2) & _numeric(year, 2) & _numeric(month, 2), F.concat(stem, F.array(F.concat(year, month))))


def _without_version(parts: Column) -> Column:
    """Parts without a whole number that stands, not first, right before a size such as 8b."""
    size = lambda i: F.get(parts, i + 1).rlike("^[0-9]+b$")
    return F.filter(parts, lambda x, i: ~((i > 0) & _numeric(x) & F.coalesce(size(i), lit(False))))


def _undated(parts: Column) -> Column:
    """Parts without a date of four digits at their end and what tells there whether the model reasons; else null."""
    n = F.size(parts)
    mode = F.when(F.get(parts, n - 1) == "reasoning", F.when(F.get(parts, n - 2) == "non", 2).otherwise(1)).otherwise(0)
    rest = F.slice(parts, 1, F.greatest(n - mode, lit(0)))
    return F.when((F.size(rest) > 1) & _numeric(F.get(rest, F.size(rest) - 1), 4), F.slice(rest, 1, F.size(rest) - 1))


def spellings(ids: DataFrame) -> DataFrame:
    """(source, model_id, ord, spelling): each id itself first, then what else it may be stored under, each once."""
    parts, own = F.split("model_id", "-"), c("model_id")
    joined = lambda x: F.array_join(x, "-")
    others = [F.when(c("source") == name, F.try_element_at(F.create_map(*[lit(x) for kv in known.items() for x in kv]), own)) for name, known in SPELLINGS.items()]
    for preview, model in PREVIEWS.items():
        rest = F.split(F.replace(own, lit(preview), lit("")), "-")
        dated = own.startswith(preview) & ((own == preview) | (F.size(rest) == 3) & _numeric(F.get(rest, 1), 2) & _numeric(F.get(rest, 2), 4))
        others.append(F.when((c("source") == "google") & dated, model))
    stem = _dated_stem(parts)
    others += [F.when(c("source") == "mistral", joined(stem)), F.when(c("source") == "mistral", joined(_without_version(stem))), F.when(c("source") == "xai", joined(_undated(parts)))]
    each = F.array_distinct(F.array_compact(F.array(own, *others)))
    return ids.select("source", "model_id", F.posexplode(each).alias("ord", "spelling"))


def read(pages: DataFrame, names: tuple[str, ...] | None = None) -> Pages:
    """A table of pages (source, url, body, and maybe run), read once for all sources or those named."""
    return Pages.of_table(pages, {n: READINGS[n] for n in names or sorted(SOURCES)})


def all_priced(pages: DataFrame | Pages, names: tuple[str, ...] | None = None) -> DataFrame:
    """PRICED rows of all sources, or those named, over one table of pages."""
    found = pages if isinstance(pages, Pages) else read(pages, names)
    made = [SOURCES[n](found.of(n)) for n in found.present() if not names or n in names]  # sources without a page cost nothing
    return reduce(DataFrame.unionByName, made) if made else found.bodies.sparkSession.createDataFrame([], PRICED)


def detected(priced: DataFrame) -> DataFrame:
    """(source, run, model_id) of ids whose row can be read, priced or not."""
    return priced.where("fault is null").select("source", "run", "model_id")


def priced_ids(priced: DataFrame) -> DataFrame:
    """(source, run, model_id) of ids that the pages price: what absence goes by where a source lists more than it prices."""
    return priced.where("rates is not null").select("source", "run", "model_id")
