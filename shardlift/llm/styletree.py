"""Main texts of pages by a site style tree: same-host pages merged, nodes weighed by entropy, low branches removed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import pieces, small_batches, widened, with_columns
from shardlift.llm.markup import DIGITS, Page, article_nodes, parse
from shardlift.shared import write_shared

# Share of content in the importance of a node with one kind of child, and its power for each further one.
GAMMA = 0.9
# A branch goes when no node in it is as important as this.
IMPORTANCE = 0.2
# Pages that have to hold a node before it is called unimportant.
MIN_PAGES = 8
ELEMENT, STYLE, FEATURE = 0, 1, 2
_MASK = (1 << 63) - 1


def host_of(url: Column) -> Column:
    """Host of a URL, in lower case; '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _number(*parts: str | int) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) & _MASK


def merged_nodes(page: Page, host: str) -> tuple[list[int], list[int], list[int]]:
    """For each node its element and style in the host's tree, and how many kinds of children it has.

    An element is a place below a style of its parent; a style is the order of the kinds of children. Neighbours of
    one kind are one element, so that a long and a short list are the same place. Numbers depend on the way from the
    top alone, so trees of pages merge by equal numbers.
    """
    n = len(page.parent)
    children: list[list[int]] = [[] for _ in range(n)]
    for k in range(1, n):
        children[page.parent[k]].append(k)
    element, style, kinds = [0] * n, [0] * n, [0] * n
    element[0] = _number(host)
    # Parents stand before their children.
    for k in range(n):
        runs: list[list[int]] = []
        for child in children[k]:
            if runs and page.signature[runs[-1][0]] == page.signature[child]:
                runs[-1].append(child)
            else:
                runs.append([child])
        style[k] = _number(element[k], *(page.signature[run[0]] for run in runs))
        kinds[k] = len(runs)
        for place, run in enumerate(runs):
            number = _number(style[k], place)
            for child in run:
                element[child] = number
    return element, style, kinds


def _features(page: Page, element: list[int]) -> set[tuple[int, int]]:
    """What a node shows: its blocks, digits alike, and the targets of its links."""
    shown = {(element[node], _number("text", DIGITS.sub("0", text))) for node, text in page.blocks}
    return shown | {(element[node], _number("link", link)) for node, link in page.links}


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        counts: Counter[tuple[int, int, int, int]] = Counter()
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parse(html or "")
            element, style, kinds = merged_nodes(page, host)
            counts.update((ELEMENT, e, 0, 0) for e in set(element))
            counts.update((STYLE, e, s, k) for e, s, k in zip(element, style, kinds, strict=True))
            counts.update((FEATURE, e, f, 0) for e, f in _features(page, element))
        columns = list(zip(*counts, strict=True)) if counts else [(), (), (), ()]
        names = ("kind", "element", "item", "children")
        arrays = {name: pa.array(column, pa.int64()) for name, column in zip(names, columns, strict=True)}
        yield pa.RecordBatch.from_pydict(arrays | {"n": pa.array(counts.values(), pa.int64())})


def site_tree(pages: DataFrame) -> DataFrame:
    """Rows (element, pages, presentation, content, importance) of the merged trees, from rows (host, html).

    With m pages that hold a node, its presentation importance is the entropy, to the base m, of its styles; its
    content importance is one minus the mean entropy of what it shows over the pages that show it, log n / log m for
    something on n pages. A node on one page has importance one. Both are weighed by GAMMA to the power of the kinds
    of children that the node's styles have on average: leaves are judged by content, wide nodes by presentation.

    Tasks sum their rows before they are sent, so a host with most pages is one row for each node and task.
    """
    small_batches(pages)
    rows = pages.select("host", "html").mapInArrow(
        _tree_rows, "kind long, element long, item long, children long, n long"
    )
    counted = rows.groupBy("kind", "element", "item", "children").agg(F.sum("n").alias("n"))
    counted = write_shared(counted, "style-trees")
    n = F.col("n").cast("double")
    held = F.col("pages").cast("double")
    total = counted.where(F.col("kind") == ELEMENT).select("element", F.col("n").alias("pages"))
    # Entropy of counts n: log of their sum minus the mean of log n, weighed by n.
    styles = (
        counted.where(F.col("kind") == STYLE)
        .groupBy("element")
        .agg(
            (F.log(F.sum(n)) - F.sum(n * F.log(n)) / F.sum(n)).alias("entropy"),
            (F.sum(n * F.col("children")) / F.sum(n)).alias("kinds"),
        )
    )
    features = counted.where(F.col("kind") == FEATURE).groupBy("element").agg(F.avg(F.log(n)).alias("shown"))
    tree = total.join(styles, "element").join(features, "element", "left")
    single = F.col("pages") < 2
    tree = tree.select(
        "element",
        "pages",
        "kinds",
        F.when(single, 1.0).otherwise(F.least(F.lit(1.0), F.col("entropy") / F.log(held))).alias("presentation"),
        F.when(F.col("shown").isNull(), None)
        .when(single, 1.0)
        .otherwise(F.greatest(F.lit(0.0), 1 - F.col("shown") / F.log(held)))
        .alias("content"),
    )
    share = F.pow(F.lit(GAMMA), F.greatest(F.lit(1.0), F.col("kinds")))
    share = F.when(F.col("kinds") == 0, 1.0).otherwise(share)
    blended = (1 - share) * F.col("presentation") + share * F.coalesce("content", "presentation")
    return tree.select("element", "pages", "presentation", "content", blended.alias("importance"))


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of each page that its names leave in the article."""
    for batch in pieces(batches, "html"):
        keys: list[str] = []
        elements: list[int] = []
        columns = (batch.column(name).to_pylist() for name in ("page", "host", "html"))
        for key, host, html in zip(*columns, strict=True):
            page = parse(html or "")
            element, _, _ = merged_nodes(page, host)
            inside = {e for e, kept in zip(element, article_nodes(page), strict=True) if kept}
            keys += [key] * len(inside)
            elements += inside
        yield pa.RecordBatch.from_pydict(
            {"page": pa.array(keys, pa.string()), "element": pa.array(elements, pa.int64())}
        )


def main_blocks(html: str, host: str, low: set[int]) -> list[str]:
    """The blocks that are left without named parts and without branches whose nodes are all of low importance.

    Where nothing would be left, the tree does not count: pages of a host may all be copies of one page.
    """
    page = parse(html)
    kept = article_nodes(page)
    if low:
        element, _, _ = merged_nodes(page, host)
        worth = [e not in low for e in element]
        for k in range(len(worth) - 1, 0, -1):
            if worth[k] and kept[k]:
                worth[page.parent[k]] = True
        text = [t for node, t in page.blocks if kept[node] and worth[node]]
        if text:
            return text
    return [t for node, t in page.blocks if kept[node]]


def _extracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_html"):
        columns = (batch.column(name).to_pylist() for name in ("_html", "_host", "_low"))
        texts = ["\n".join(main_blocks(html or "", host, set(low or ()))) for html, host, low in zip(*columns, strict=True)]
        slim = batch.select([name for name in batch.schema.names if name not in ("_html", "_host", "_low")])
        yield with_columns(slim, {"text": pa.array(texts, pa.string())})


def extract(pages: DataFrame, url: str = "url", html: str = "html", importance: float = IMPORTANCE) -> DataFrame:
    """All rows of `pages` without the markup but with `text`, the main text, and `n_chars`.

    What pages name themselves (elements like `nav`, roles, words of class and id) is decided by its name. The rest
    is decided by the tree of the host. Only elements of low importance on `MIN_PAGES` pages or more are joined to
    the pages that hold them.

    Null and empty pages give empty texts, null URLs and URLs without a host are one host, repeated rows and ties get
    one text each, an empty table gives no rows, columns named `text` or `n_chars` give way. A host with most of the
    pages is summed in tasks and looked up by element. A page is known by the hash of its host and markup, so copies
    are looked up once; they are never gathered.
    """
    small_batches(pages)
    host = host_of(F.col(url))
    markup = F.coalesce(F.col(html), F.lit(""))
    key = F.sha2(F.concat(host, F.lit("\n"), markup), 256)
    narrow = pages.select(key.alias("page"), host.alias("host"), markup.alias("html"))
    tree = site_tree(narrow)
    low = tree.where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < importance)).select("element")
    held = narrow.mapInArrow(_undecided, "page string, element long").join(write_shared(low, "low"), "element")
    # A page has few elements, and each page's own are gathered only.
    found = held.distinct().groupBy(F.col("page").alias("_page")).agg(F.collect_list("element").alias("_low"))
    found = write_shared(found, "removed")
    named = [name for name in pages.columns if name not in ("text", "n_chars", html)]
    rows = pages.select(*named, markup.alias("_html"), host.alias("_host"), key.alias("_key"))
    joined = rows.join(found, F.col("_key") == F.col("_page"), "left").drop("_key", "_page")
    schema = widened(joined.drop("_html", "_host", "_low"), text=T.StringType())
    texts = joined.mapInArrow(_extracting, schema)
    return texts.withColumn("n_chars", F.length("text").cast("long"))
