"""XML columns: typed surveys, nested paths, element rows and pivots.

Documents are parsed once per row inside the JVM. Every element is read as an
array, so that the first of repeated elements wins and absent ones are null;
namespaces are ignored. A malformed document yields nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import survey_date, try_convert

_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}

# Leaf elements of the two surveys.
PERSON_SURVEY = [
    "TotalPurchaseYTD", "DateFirstPurchase", "BirthDate", "MaritalStatus", "YearlyIncome", "Gender",
    "TotalChildren", "NumberChildrenAtHome", "Education", "Occupation", "HomeOwnerFlag", "NumberCarsOwned",
]
STORE_SURVEY = [
    "AnnualSales", "AnnualRevenue", "BankName", "BusinessType", "YearOpened", "Specialty", "SquareFeet",
    "Brands", "Internet", "NumberEmployees",
]


def parse_leaves(doc: Column, names: Sequence[str]) -> Column:
    """Struct with one array of texts per child element."""
    return F.from_xml(doc, ", ".join(f"`{n}` array<string>" for n in names), _OPTIONS)


def first_text(parsed: Column, name: str) -> Column:
    return F.get(parsed.getField(name), F.lit(0))


def flag(text: Column) -> Column:
    """XML boolean: 1, 0, true or false."""
    return F.when(text.isin("1", "true"), True).when(text.isin("0", "false"), False)


def with_person_survey(df: DataFrame, doc_col: str) -> DataFrame:
    """Add the 12 typed columns of a person survey."""
    s = F.col("_survey")
    text = {n: first_text(s, n) for n in PERSON_SURVEY}
    typed = {
        **text,
        "TotalPurchaseYTD": try_convert(text["TotalPurchaseYTD"], "decimal(19,4)"),
        "DateFirstPurchase": survey_date(text["DateFirstPurchase"]),
        "BirthDate": survey_date(text["BirthDate"]),
        "TotalChildren": try_convert(text["TotalChildren"], "int"),
        "NumberChildrenAtHome": try_convert(text["NumberChildrenAtHome"], "int"),
        "HomeOwnerFlag": flag(text["HomeOwnerFlag"]),
        "NumberCarsOwned": try_convert(text["NumberCarsOwned"], "int"),
    }
    return df.withColumn("_survey", parse_leaves(F.col(doc_col), PERSON_SURVEY)).withColumns(typed).drop("_survey")


def with_store_survey(df: DataFrame, doc_col: str) -> DataFrame:
    """Add the 10 columns of a store survey; numbers that do not convert become null."""
    s = F.col("_survey")
    text = {n: first_text(s, n) for n in STORE_SURVEY}
    amounts = {n: try_convert(text[n], "double").try_cast("decimal(18,2)") for n in ("AnnualSales", "AnnualRevenue")}
    counts = {n: try_convert(text[n], "int") for n in ("YearOpened", "SquareFeet", "Brands", "NumberEmployees")}
    typed = {**text, **amounts, **counts}
    return df.withColumn("_survey", parse_leaves(F.col(doc_col), STORE_SURVEY)).withColumns(typed).drop("_survey")


def _flat(nested: Column) -> Column:
    return F.flatten(F.filter(nested, lambda a: a.isNotNull()))


def with_warranty(df: DataFrame, doc_col: str) -> DataFrame:
    """Add warranty period and maintenance years of a catalogue description, first match of each path."""
    shape = (
        "Features array<struct<"
        "Warranty: array<struct<WarrantyPeriod: array<string>>>, "
        "Maintenance: array<struct<NoOfYears: array<string>>>>>"
    )
    features = F.col("_doc").getField("Features")

    def first_of(group: str, leaf: str) -> Column:
        return F.get(_flat(_flat(features.getField(group)).getField(leaf)), F.lit(0))

    return (
        df.withColumn("_doc", F.from_xml(F.col(doc_col), shape, _OPTIONS))
        .withColumns({
            "WarrantyPeriod": first_of("Warranty", "WarrantyPeriod"),
            "MaintenanceYears": first_of("Maintenance", "NoOfYears"),
        })
        .drop("_doc")
    )


def _alike(names: Sequence[str]) -> set[str]:
    """The names that differ from another one by case only; a struct cannot tell them apart."""
    lower = [n.lower() for n in names]
    return {n for n in names if lower.count(n.lower()) > 1}


def _texts(doc: Column, parsed: Column, name: str, alike: set[str]) -> Column:
    """Texts of the children with a name: from the parsed struct, or by path where the struct would mix names."""
    found = parsed.getField(name)
    if name not in alike:
        return found
    return F.when(found.isNotNull(), F.xpath(doc, F.lit(f"/*/*[local-name()='{name}']/text()")))


def _fields(names: Sequence[str]) -> list[str]:
    """One name for each struct field."""
    return list({n.lower(): n for n in names}.values())


def shred(df: DataFrame, id_cols: Sequence[str], doc_col: str, names: Sequence[str]) -> DataFrame:
    """Rows ``(ids, ElementName, ElementValue)``, one per child element with one of the given names."""
    if not names:
        return df.select(*id_cols, F.lit("").alias("ElementName"), F.lit("").alias("ElementValue")).limit(0)
    docs = df.filter(F.col(doc_col).isNotNull())
    alike = _alike(names)
    parsed = docs.select(*id_cols, F.col(doc_col).alias("_doc"), parse_leaves(F.col(doc_col), _fields(names)).alias("_p"))
    pairs = F.array(*[
        F.struct(F.lit(n).alias("ElementName"), _texts(F.col("_doc"), F.col("_p"), n, alike).alias("_values")) for n in names
    ])
    return (
        parsed.select(*id_cols, F.inline(F.filter(pairs, lambda p: p["_values"].isNotNull())))
        .select(*id_cols, "ElementName", F.explode("_values").alias("ElementValue"))
    )


def _tag_names(df: DataFrame, doc_col: str) -> DataFrame:
    """Distinct names of start tags: a superset of the child elements, reduced inside each task first."""
    tags = F.regexp_extract_all(F.col(doc_col), F.lit(r"(?U)<(?:[\w.-]+:)?([\p{L}_][\w.\u00B7-]*)"), 1)
    return df.select(F.explode(F.array_distinct(tags)).alias("ElementName")).distinct()


def element_names(df: DataFrame, doc_col: str) -> list[str]:
    """Names of the child elements over all documents, sorted.

    Tag names are found first, then one parse keeps those that really occur as
    children. The list is as long as the document type has names, not as there are documents.
    """
    found = sorted(r[0] for r in _tag_names(df, doc_col).collect())
    if not found:
        return []
    alike = _alike(found)
    parsed = df.filter(F.col(doc_col).isNotNull()).select(F.col(doc_col).alias("_doc"), parse_leaves(F.col(doc_col), _fields(found)).alias("_p"))
    texts = [_texts(F.col("_doc"), F.col("_p"), n, alike) for n in found]
    row = parsed.agg(*[F.bool_or(t.isNotNull() & (F.lit(n not in alike) | (F.size(t) > 0))).alias(f"c{i}") for i, (n, t) in enumerate(zip(found, texts))]).first()
    return [n for i, n in enumerate(found) if row[i]]


#: Tasks to which ``pivot_long`` deals its rows at most: up to this number Spark writes them out without holding them.
DEALT = 200


def pivot_long(df: DataFrame, id_cols: Sequence[str], name_col: str, value_col: str, names: Sequence[str] | None = None) -> DataFrame:
    """Name/value rows to one column per name, largest value; the names are discovered if not given.

    Spark finds the largest text by sorting, in the task that reads the rows too. They are dealt out first, so that
    a task sorts its share of them and not what one file holds.
    """
    if names is None:
        names = sorted(r[0] for r in df.select(name_col).distinct().collect() if r[0] is not None)
    if not names:
        return df.select(*id_cols).distinct()
    tasks = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), DEALT)
    dealt = df.select(*id_cols, name_col, value_col).repartition(tasks, *id_cols, name_col)
    return dealt.groupBy(*id_cols).pivot(name_col, list(names)).agg(F.max(value_col))


def _as_type(text: Column, target: str | None) -> Column:
    if target == "boolean":
        return flag(text)
    if target == "timestamp_ntz":
        return survey_date(text)
    return try_convert(text, target) if target else text


def pivot_elements(
    df: DataFrame, id_cols: Sequence[str], doc_col: str, names: Sequence[str] | None = None, types: dict[str, str] | None = None
) -> DataFrame:
    """One row per id with a column per element name (largest text wins), cast by ``types``.

    Without ``names`` the column list is discovered from the data. A document
    is reduced to its row of largest texts before the rows of an id meet, so
    elements never travel one by one. Ids without any element give no row.
    """
    names = element_names(df, doc_col) if names is None else list(names)
    if not names:
        return df.select(*id_cols).limit(0)
    if _alike(names):
        raise ValueError("names that differ by case only cannot be columns; use shred for the long form")
    parsed = df.filter(F.col(doc_col).isNotNull()).select(*id_cols, parse_leaves(F.col(doc_col), names).alias("_p"))
    wide = parsed.select(*id_cols, *[F.array_max(F.col("_p").getField(n)).alias(n) for n in names])
    filled = wide.filter(F.coalesce(*[F.col(f"`{n}`") for n in names]).isNotNull())
    merged = filled.groupBy(*id_cols).agg(*[F.max(f"`{n}`").alias(n) for n in names])
    return merged.select(*id_cols, *[_as_type(F.col(f"`{n}`"), (types or {}).get(n)).alias(n) for n in names])
