"""Documents as VARIANT: read a path, compare whole documents, turn nested numbers into text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def field(document: Column, path: str, dtype: str = "string") -> Column:
    """Value at a path such as ``wallet.balance``; null when absent, JSON null or not castable."""
    return F.try_variant_get(document, "$." + path, dtype)


def canonical(document: Column) -> Column:
    """Comparable text of a document: a VARIANT has no equality, but its JSON text has sorted keys."""
    return F.to_json(document)


def nested_to_text(df: DataFrame, paths) -> DataFrame:
    """Cast number leaves below struct columns to string, e.g. ``rewards.GO.balance``.

    A path that the schema lacks is left alone (``withField`` alone would add it); null parents stay null.
    """
    for path in paths:
        root, *rest = path.split(".")
        if not rest or not _is_number(df.schema, [root, *rest]):
            continue
        leaf = F.col(root)
        for part in rest:
            leaf = leaf.getField(part)
        df = df.withColumn(root, F.col(root).withField(".".join(rest), leaf.cast("string")))
    return df


def numbers_to_text(document: Column, paths) -> Column:
    """A VARIANT whose numbers at ``paths``, e.g. ``rewards.GO.balance``, are text of the same digits; all else stays as it is.

    A path goes through arrays on its way: it holds for each of their elements. A path that a document lacks, or at which it has
    no number, changes nothing. Null documents stay null.
    """
    tree = {}
    for path in paths:
        below = tree
        for key in path.split("."):
            below = below.setdefault(key, {})
        below[_HERE] = True
    return _once(document, lambda d: _rewritten(d, tree)) if tree else document


_HERE = object()  # in a tree of keys: a path ends here


def _once(value: Column, use) -> Column:
    """``use(value)``, however often that names the value, with the value computed once: a column named twice is computed twice."""
    return F.get(F.transform(F.array(value), use), 0)


def _rewritten(value: Column, tree: dict) -> Column:
    """All paths in one pass. The size of the expression grows with the tree, its cost with the document."""
    below = {k: v for k, v in tree.items() if k is not _HERE}
    if _HERE in tree:
        number = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        value = F.when(number, F.to_json(value).cast("variant")).otherwise(value)
    if not below:
        return value

    def changed(k, x):
        first, *others = below
        out = F.when(k == first, _rewritten(x, below[first]))
        for key in others:
            out = out.when(k == key, _rewritten(x, below[key]))
        return out.otherwise(x)

    def inside(v):
        new = F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), changed)
        return F.coalesce(F.to_variant_object(new), v)

    def elements(v):
        many = F.try_variant_get(v, "$", "array<variant>")
        return _once(many, lambda m: _once(
            F.transform(F.coalesce(m, F.array(v)), inside), lambda new: F.when(m.isNotNull(), F.to_variant_object(new)).otherwise(F.get(new, 0))))

    return _once(value, elements)


def _is_number(dtype: T.DataType, path) -> bool:
    for part in path:
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return False
        dtype = dtype[part].dataType
    return isinstance(dtype, T.NumericType)
