"""Index settings: dotted keys to a tree, hoisting, replica rounding, rejected fields.

Settings are handled as leaves, `array<struct<path array<string>, ord int, value string>>`, inside
the row they belong to: no step shuffles, and a tree is written from its sorted leaves in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.fixed import REJECTED_SETTINGS
from shardlift.functions.jsontext import (
    as_int,
    entries,
    is_object,
    keys_of,
    let,
    member,
    quote,
    replace_member,
)

LEAVES = "array<struct<path:array<string>,ord:int,value:string>>"


def _leaf(path: Column, ord_: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), ord_.cast("int").alias("ord"), value.alias("value"))


def _no_leaves() -> Column:
    return F.array().cast(LEAVES)


def _tree(leaves: Column, problem: Column) -> Column:
    return F.struct(leaves.alias("leaves"), problem.alias("problem"))


def _starts_with(path: Column, prefix: Column) -> Column:
    return F.slice(path, F.lit(1), F.size(prefix)) == prefix


def _sorted(leaves: Column) -> Column:
    return F.array_sort(leaves)


def flat_entries(items: Column) -> Column:
    """Entries of a flat settings object to leaves: `a.b` is the path [a, b]; trailing dots do not count."""

    def leaf(e: Column, i: Column) -> Column:
        key = F.when(e["key"] == "", e["key"]).otherwise(F.regexp_replace(e["key"], r"\.+$", ""))
        return _leaf(F.split(key, r"\."), i, e["value"])

    return F.transform(items, leaf)


def _nested(leaf: Column) -> Column:
    """A leaf holding an object as leaves one level down."""
    return F.transform(
        entries(leaf["value"]),
        lambda e: _leaf(F.concat(leaf["path"], F.array(e["key"])), leaf["ord"], e["value"]),
    )


def _open_object(leaf: Column, also: Column) -> Column:
    return is_object(leaf["value"]) & (leaf["value"] != "{}") & also


def _overlaps(leaves: Column) -> Column:
    """Whether some path equals or extends another: in sorted order it must then extend its neighbour."""
    return let(
        _sorted(leaves),
        lambda ordered: F.exists(
            F.transform(
                ordered,
                lambda x, i: F.coalesce(
                    _starts_with(x["path"], F.get(ordered, i - 1)["path"]), F.lit(False)
                ),
            ),
            lambda hit: hit,
        ),
    )


def _in_path_order(leaves: Column, writes: Column) -> Column:
    """Leaves and writes as one array: what extends a path follows it directly, in one block."""

    def item(is_leaf: bool, value: bool):
        return lambda x: F.struct(
            x["path"].alias("path"),
            F.lit(is_leaf).alias("leaf"),
            x["ord"].alias("ord"),
            (x["value"] if value else F.lit(None).cast("string")).alias("value"),
        )

    return F.array_sort(F.concat(F.transform(leaves, item(True, True)), F.transform(writes, item(False, False))))


def _flagged(items: Column, flags: Column) -> Column:
    """The items whose flag is 1; flags are a text with a character for each item.

    A pass that gathers rows in an array would copy it at every step; a text costs next to nothing.
    """
    return F.filter(items, lambda x, i: F.substring(flags, i + 1, F.lit(1)) == "1")


def _below(ordered: Column) -> Column:
    """Flags, from the last of the items in path order to the first: whether a write goes to a path under its own.

    One pass: a path is written below if the next one extends it.
    """

    def step(after: Column, x: Column) -> Column:
        same = F.coalesce(after["path"] == x["path"], F.lit(False))
        extends = F.coalesce(_starts_with(after["path"], x["path"]), F.lit(False))
        below = F.when(F.when(same, after["below"]).otherwise(extends), "1").otherwise("0")
        return F.struct(
            x["path"].alias("path"), (below == "1").alias("below"), F.concat(after["flags"], below).alias("flags")
        )

    none = F.struct(
        F.lit(None).cast("array<string>").alias("path"), F.lit(False).alias("below"), F.lit("").alias("flags")
    )
    return F.aggregate(F.reverse(ordered), none, step)["flags"]


def _expand_shared(leaves: Column, writes: Column) -> Column:
    """Open object values that a longer key writes into, as deep as the row's longest key goes."""

    def opened_where(items: Column, flags: Column) -> Column:
        last = F.size(items)

        def open_one(x: Column, i: Column) -> Column:
            leaf = _leaf(x["path"], x["ord"], x["value"])
            below = F.substring(flags, last - i, F.lit(1)) == "1"
            none = F.array().cast(LEAVES)
            return F.when(~x["leaf"], none).when(_open_object(x, below), _nested(leaf)).otherwise(F.array(leaf))

        return F.flatten(F.transform(items, open_one))

    def one_level(opened: Column) -> Column:
        closed = F.exists(opened, lambda x: _open_object(x, F.lit(True)))
        done = let(_in_path_order(opened, writes), lambda items: let(_below(items), lambda f: opened_where(items, f)))
        return F.when(closed, done).otherwise(opened)

    longest = F.array_max(F.transform(writes, lambda w: F.size(w["path"])))
    return F.aggregate(F.sequence(F.lit(1), longest), leaves, lambda opened, _: one_level(opened))


_STACK = (
    "array<struct<path:array<string>,latest:int,writes:array<int>,values:array<struct<ord:int,value:string>>>>"
)


def _applied(leaves: Column, writes: Column) -> Column:
    """struct<kept, blocked>: leaves that no later write replaced, and whether a write had to pass through a value.

    One pass in path order with a stack of the paths above the present one. An entry holds the latest write at its
    path or above, all writes there, and the values that stood at its path. A leaf is replaced by a later write at
    its own path or above; a write is blocked by a value above it which no write had replaced between the two.
    """

    def above(stack: Column, x: Column) -> Column:
        return F.filter(stack, lambda e: _starts_with(x["path"], e["path"]))

    def stops(stack: Column, x: Column) -> Column:
        def stands(e: Column) -> Column:
            return F.exists(
                e["values"],
                lambda v: (v["ord"] < x["ord"])
                & ~F.exists(e["writes"], lambda o: (o > v["ord"]) & (o < x["ord"])),
            )

        return F.exists(stack, lambda e: (F.size(e["path"]) < F.size(x["path"])) & stands(e))

    def pushed(stack: Column, x: Column) -> Column:
        """The stack with the item in the entry of its path, which is new unless the top has it."""
        top = F.get(stack, F.size(stack) - 1)
        same = F.coalesce(top["path"] == x["path"], F.lit(False))
        below = F.when(same, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack)
        value = F.array(F.struct(x["ord"].alias("ord"), x["value"].alias("value")))
        none = F.array().cast("array<struct<ord:int,value:string>>")
        own = F.when(same, top["values"]).otherwise(none)
        wrote = F.when(x["leaf"], F.array().cast("array<int>")).otherwise(F.array(x["ord"]))
        entry = F.struct(
            x["path"].alias("path"),
            F.when(x["leaf"], top["latest"]).otherwise(F.greatest(top["latest"], x["ord"])).alias("latest"),
            F.concat(F.coalesce(top["writes"], F.array().cast("array<int>")), wrote).alias("writes"),
            F.concat(own, F.when(x["leaf"] & (x["value"] != "{}"), value).otherwise(none)).alias("values"),
        )
        return F.concat(below, F.array(entry))

    def looked_at(stack: Column, x: Column, so_far: Column) -> Column:
        latest = F.get(stack, F.size(stack) - 1)["latest"]
        kept = x["leaf"] & F.coalesce(latest <= x["ord"], F.lit(True))
        return F.struct(
            pushed(stack, x).alias("stack"),
            F.concat(so_far["flags"], F.when(kept, "1").otherwise("0")).alias("flags"),
            (so_far["blocked"] | (~x["leaf"] & stops(stack, x))).alias("blocked"),
        )

    def step(so_far: Column, x: Column) -> Column:
        return let(above(so_far["stack"], x), lambda stack: looked_at(stack, x, so_far))

    def kept(items: Column) -> Column:
        none = F.struct(
            F.array().cast(_STACK).alias("stack"), F.lit("").alias("flags"), F.lit(False).alias("blocked")
        )
        return let(
            F.aggregate(items, none, step),
            lambda d: F.struct(_flagged(items, d["flags"]).alias("kept"), d["blocked"].alias("blocked")),
        )

    return let(_in_path_order(leaves, writes), kept)


def tree_leaves(text: Column) -> Column:
    """struct<leaves, problem> of a flat settings object.

    Keys apply in document order. A later key replaces whatever stands at its path; a key that has to
    pass through a plain value is a problem; a key that passes through an object value merges into it.
    """

    def without_filled(kept: Column) -> Column:
        """Empty objects go when something stands under them; the items are leaves, in path order."""
        filled = let(
            _below(kept),
            lambda flags: F.filter(
                kept,
                lambda x, i: (x["value"] != "{}") | (F.substring(flags, F.size(kept) - i, F.lit(1)) == "0"),
            ),
        )
        return F.transform(
            F.when(F.exists(kept, lambda x: x["value"] == "{}"), filled).otherwise(kept),
            lambda x: _leaf(x["path"], x["ord"], x["value"]),
        )

    def merged(writes: Column) -> Column:
        return let(
            _applied(_expand_shared(writes, writes), writes),
            lambda done: _tree(
                without_filled(done["kept"]),
                F.when(done["blocked"], F.lit("settings key passes through a value")),
            ),
        )

    def build(items: Column) -> Column:
        none = F.lit(None).cast("string")
        return (
            F.when(items.isNull(), _tree(_no_leaves(), F.lit("settings are missing or not an object")))
            .when(
                F.exists(items, lambda e: e["key"].rlike(r"^\.+$")),
                _tree(_no_leaves(), F.lit("settings key has no name")),
            )
            .otherwise(
                let(
                    flat_entries(items),
                    lambda writes: F.when(_overlaps(writes), merged(writes)).otherwise(_tree(writes, none)),
                )
            )
        )

    return let(entries(text), build)


def plain_leaves(text: Column) -> Column:
    """struct<leaves, problem> of a settings object whose keys are taken as they are, dots and all."""
    return let(
        entries(text),
        lambda items: F.when(items.isNull(), _tree(_no_leaves(), F.lit("settings are missing or not an object"))).otherwise(
            _tree(F.transform(items, lambda e, i: _leaf(F.array(e["key"]), i, e["value"])), F.lit(None).cast("string"))
        ),
    )


def leaf_value(leaves: Column, path: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(p) for p in path])
    return F.get(F.filter(leaves, lambda x: x["path"] == wanted), F.lit(0))["value"]


def hoist_leaves(leaves: Column) -> Column:
    """struct<leaves, problem>: everything under `index` moves up one level and wins over same-named siblings."""
    level = F.array(F.lit("index"))

    def opened(x: Column) -> Column:
        return F.when(_open_object(x, x["path"] == level), _nested(x)).otherwise(F.array(x))

    def lifted(all_: Column) -> Column:
        inside = F.filter(all_, lambda x: (x["path"][0] == "index") & (F.size(x["path"]) > 1))
        return F.transform(
            inside,
            lambda x: _leaf(F.slice(x["path"], F.lit(2), F.size(x["path"]) - 1), x["ord"], x["value"]),
        )

    def join(all_: Column, moved: Column, names: Column) -> Column:
        # An `index` member inside `index` is removed together with the level itself.
        kept = F.concat(
            F.filter(all_, lambda x: (x["path"][0] != "index") & ~F.array_contains(names, x["path"][0])),
            F.filter(moved, lambda x: x["path"][0] != "index"),
        )
        plain = F.exists(all_, lambda x: (x["path"] == level) & ~is_object(x["value"]))
        return _tree(kept, F.when(plain, F.lit("settings.index is not an object")))

    return let(
        F.flatten(F.transform(leaves, opened)),
        lambda all_: let(
            lifted(all_),
            lambda moved: let(
                F.transform(moved, lambda x: x["path"][0]), lambda names: join(all_, moved, names)
            ),
        ),
    )


def round_replicas(value: Column, dimensionality: int) -> Column:
    """Replica count whose number of copies is the next multiple of the dimensionality."""

    def rounded(copies: Column) -> Column:
        over = copies % dimensionality
        return copies + F.when(over > 0, dimensionality - over).otherwise(0) - 1

    return let(as_int(value) + 1, rounded)


def replica_leaves(leaves: Column, dimensionality: int) -> Column:
    """Round `number_of_replicas`; a tree of that name reads as 0, an absent one stays absent."""
    name = "number_of_replicas"

    def fixed(x: Column) -> Column:
        value = F.when(F.size(x["path"]) == 1, x["value"]).otherwise(F.lit("{}"))
        return _leaf(
            F.array(F.lit(name)), x["ord"], round_replicas(value, dimensionality).cast("string")
        )

    return let(
        leaves,
        lambda all_: F.concat(
            F.filter(all_, lambda x: x["path"][0] != name),
            F.transform(F.slice(F.filter(all_, lambda x: x["path"][0] == name), 1, 1), fixed),
        ),
    )


def drop_rejected(leaves: Column, names: Sequence[str] = REJECTED_SETTINGS) -> Column:
    return F.filter(leaves, lambda x: ~x["path"][0].isin(*names))


def tree_text(leaves: Column) -> Column:
    """Leaves to a JSON object with sorted keys.

    In sorted order each leaf closes the levels it does not share with the one before it and opens its
    own, so the text is written in one pass whatever the depth.
    """

    def shared_levels(path: Column, before: Column) -> Column:
        return F.size(
            F.filter(
                F.transform(path, lambda _, d: d + 1),
                lambda d: F.coalesce(
                    F.slice(before, F.lit(1), d) == F.slice(path, F.lit(1), d), F.lit(False)
                ),
            )
        )

    def piece(x: Column, before: Column, shared: Column) -> Column:
        path = x["path"]
        closing = F.when(before.isNull(), F.lit("")).otherwise(
            F.concat(F.repeat(F.lit("}"), F.size(before) - 1 - shared), F.lit(","))
        )
        opening = F.array_join(
            F.transform(
                F.slice(path, shared + 1, F.size(path) - 1 - shared),
                lambda k: F.concat(quote(k), F.lit(":{")),
            ),
            "",
        )
        return F.concat(closing, opening, quote(F.element_at(path, -1)), F.lit(":"), x["value"])

    def write(ordered: Column) -> Column:
        body = F.transform(
            ordered,
            lambda x, i: let(
                F.get(ordered, i - 1)["path"],
                lambda before: let(
                    shared_levels(x["path"], before), lambda shared: piece(x, before, shared)
                ),
            ),
        )
        depth = F.size(F.get(ordered, F.size(ordered) - 1)["path"])
        return F.when(F.size(ordered) == 0, F.lit("{}")).otherwise(
            F.concat(F.lit("{"), F.array_join(body, ""), F.repeat(F.lit("}"), depth))
        )

    return let(_sorted(leaves), write)


def flat_to_tree(text: Column) -> Column:
    """struct<value, problem>: flat settings text to tree text."""
    return let(
        tree_leaves(text),
        lambda tree: F.struct(
            F.when(tree["problem"].isNull(), tree_text(tree["leaves"])).alias("value"),
            tree["problem"].alias("problem"),
        ),
    )


def hoist_members(items: Column) -> Column:
    """struct<items, problem> of settings that already are a tree: members of `index` move up and win."""

    def moved(all_: Column, inner: Column, names: Column) -> Column:
        return F.concat(
            F.filter(all_, lambda e: (e["key"] != "index") & ~F.array_contains(names, e["key"])),
            F.filter(inner, lambda e: e["key"] != "index"),
        )

    def lift(all_: Column, level: Column) -> Column:
        inside = let(
            entries(level),
            lambda inner: let(keys_of(inner), lambda names: moved(all_, inner, names)),
        )
        problem = F.when(level.isNotNull() & ~is_object(level), F.lit("settings.index is not an object"))
        return F.struct(
            F.when(is_object(level), inside).otherwise(all_).alias("items"), problem.alias("problem")
        )

    return let(items, lambda all_: let(member(all_, "index"), lambda level: lift(all_, level)))


def replica_members(items: Column, dimensionality: int) -> Column:
    """Round a top-level `number_of_replicas` member if it is there."""
    name = "number_of_replicas"
    return let(
        items,
        lambda all_: replace_member(
            all_, name, round_replicas(member(all_, name), dimensionality).cast("string")
        ),
    )
