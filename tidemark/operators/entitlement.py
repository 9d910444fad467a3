"""Who may see an item: policy routing, POSIX masks, directory gates, sensitivity labels, lineage.

Resources meet policies through an index of their patterns, by equality; policies are broadcast only below
a checked count. Group names compare without case. All set algebra is on arrays, inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import written
from tidemark.sources.tables import SourceRefused

ACCESS, MASKING, ROW_FILTER = 0, 1, 2
MAX_BROADCAST_POLICIES = 50_000

_GRANT = T.StructType([T.StructField("groups", T.ArrayType(T.StringType())), T.StructField("users", T.ArrayType(T.StringType())), T.StructField("accesses", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("isAllowed", T.BooleanType())])))])
_RESOURCE = T.StructType([T.StructField("values", T.ArrayType(T.StringType())), T.StructField("isExcludes", T.BooleanType()), T.StructField("isRecursive", T.BooleanType())])
#: A policy as its service exports it.
POLICY = T.StructType(
    [
        T.StructField("id", T.LongType()), T.StructField("service", T.StringType()), T.StructField("name", T.StringType()), T.StructField("isEnabled", T.BooleanType()),
        T.StructField("policyType", T.IntegerType()), T.StructField("resources", T.MapType(T.StringType(), _RESOURCE)), T.StructField("policyItems", T.ArrayType(_GRANT)),
        T.StructField("denyPolicyItems", T.ArrayType(_GRANT)), T.StructField("allowExceptions", T.ArrayType(_GRANT)), T.StructField("denyExceptions", T.ArrayType(_GRANT)),
        T.StructField("isDenyAllElse", T.BooleanType()), T.StructField("conditions", T.ArrayType(T.StringType())), T.StructField("validitySchedules", T.ArrayType(T.StringType())), T.StructField("zoneName", T.StringType()),
    ]
)


def parse_policies(raw: DataFrame, column: str = "value") -> DataFrame:
    """Policies from JSON text, one row each; absent isEnabled and isAllowed are true; one row per id."""
    d = raw.select(F.from_json(column, POLICY).alias("p")).where("p.id is not null").select("p.*")
    return d.withColumn("isEnabled", F.coalesce("isEnabled", F.lit(True))).dropDuplicates(["id"])


def unreadable_policies(policies: DataFrame) -> DataFrame:
    """Policies with constructs that can't be mirrored; a run that finds any is refused. Zones,
    conditions and schedules refuse; deny exceptions and named users only warn."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    users = F.exists(F.coalesce("policyItems", F.array().cast(T.ArrayType(_GRANT))), lambda g: F.coalesce(F.size(g["users"]) > 0, F.lit(False)))
    refuse = some("conditions") | some("validitySchedules") | (F.coalesce("zoneName", F.lit("")) != "")
    warn = some("denyExceptions") | users
    d = policies.where(F.col("isEnabled")).withColumn("effect", F.when(refuse, "refuse").when(warn, "warn"))
    return d.where("effect is not null").select("id", "name", "effect")


def dangerous_tag_policies(policies: DataFrame) -> DataFrame:
    """id and name of the enabled policies of a tag service that deny, mask or filter rows. Tags are not
    evaluated here, so what such a policy takes away would be granted."""
    takes = (F.coalesce(F.size("denyPolicyItems"), F.lit(0)) > 0) | F.coalesce("policyType", F.lit(ACCESS)).isin(MASKING, ROW_FILTER)
    return policies.where(F.col("isEnabled") & takes).select("id", "name")


def refuse_tag_policies(policies: DataFrame | None, named: int = 10) -> None:
    """Refuses a run whose tag service (None: there is none) holds such policies, naming the first of them.
    Their number and a few ids reach the driver."""
    if policies is None:
        return
    found = dangerous_tag_policies(policies)
    if n := found.count():
        ids = ", ".join(str(r["id"]) for r in found.orderBy("id").limit(named).collect())
        more = f" and {n - named} more" if n > named else ""
        raise SourceRefused(f"{n} tag policies deny, mask or filter: {ids}{more}")


def _quoted(value: Column) -> Column:
    return F.regexp_replace(value, r"([\\.\[\]{}()+^$|])", r"\\$1")


def name_pattern(value: Column) -> Column:
    """* is any run, ? one character."""
    return F.regexp_replace(F.regexp_replace(_quoted(value), r"\*", ".*"), r"\?", ".")


def _trimmed(path: Column) -> Column:
    return F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", ""))


def path_pattern(value: Column, recursive: Column) -> Column:
    """* and ? stay within one path segment; recursive takes all below."""
    body = F.regexp_replace(F.regexp_replace(_quoted(_trimmed(value)), r"\*", "[^/]*"), r"\?", "[^/]")
    return F.when(body == "/", F.when(recursive, F.lit("/.*")).otherwise(body)).otherwise(F.concat(body, F.when(recursive, "(/.*)?").otherwise("")))


def _any_of(flags: str, patterns: Column) -> Column:
    """One expression for all patterns of a policy, compiled once for many candidates; null without any."""
    return F.when(F.size(patterns) > 0, F.concat(F.lit(f"{flags}\\A(?:"), F.array_join(patterns, "|"), F.lit(r")\z")))


def _values(name: str) -> Column:
    return F.coalesce(F.col("resources")[name]["values"], F.array().cast("array<string>"))


def _flag(name: str, flag: str) -> Column:
    return F.coalesce(F.col("resources")[name][flag], F.lit(False))


def _patterns() -> list[Column]:
    """What covers() and its kin read: a policy's expressions, and whether they name what is excluded."""
    paths = lambda recursive: F.transform(_values("path"), lambda v: path_pattern(v, recursive))
    names = [_any_of("(?is)", F.transform(_values(n), name_pattern)).alias(f"{n}_like") for n in ("database", "table")]
    places = [_any_of("", paths(r)).alias(n) for n, r in (("path_like", _flag("path", "isRecursive")), ("path_wide", F.lit(True)), ("path_narrow", F.lit(False)))]
    lists = [F.transform(_values(n), _plain).alias(f"{n}_values") for n in ("database", "table")] + [_values("path").alias("path_values")]
    return [*names, *places, *lists, *(_flag(n, "isExcludes").alias(f"{n}_excludes") for n in ("database", "table", "path"))]


def _hits(pattern: str, candidate: Column) -> Column:
    return F.coalesce(F.regexp_like(candidate, F.col(pattern)), F.lit(False))


def covers(name: str, candidate: Column) -> Column:
    """Whether a policy's values of a resource take the candidate, without case; excluded values take all others."""
    hit = _hits(f"{name}_like", candidate)
    return F.when(F.col(f"{name}_like").isNotNull() & F.col(f"{name}_excludes"), ~hit).otherwise(hit)


def covers_path(path: Column) -> Column:
    """The same for paths, in which case counts."""
    return covers("path", _trimmed(path))


def covers_path_for_deny(path: Column) -> Column:
    """A deny reaches below its path, and an excluding one spares only the path itself."""
    wide, narrow = _hits("path_wide", _trimmed(path)), _hits("path_narrow", _trimmed(path))
    return F.when(F.col("path_like").isNull(), F.lit(False)).when(F.col("path_excludes"), ~narrow).otherwise(wide)


def column_scoped() -> Column:
    v = _values("column")
    return F.when(F.size(v) == 0, F.lit(False)).otherwise(_flag("column", "isExcludes") | ~F.forall(v, lambda x: x == "*"))


def _items(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(T.ArrayType(_GRANT)))


def _reads(item: Column) -> Column:
    return F.exists(item["accesses"], lambda a: F.lower(a["type"]).isin("select", "read", "all") & F.coalesce(a["isAllowed"], F.lit(True)))


def _groups(items: Column) -> Column:
    flat = F.flatten(F.transform(items, lambda x: F.coalesce(x["groups"], F.array().cast("array<string>"))))
    return F.array_distinct(F.transform(F.filter(flat, lambda g: F.trim(g) != ""), lambda g: F.lower(g)))


def _prepared(policies: DataFrame) -> DataFrame:
    """Enabled policies with the columns that routing needs; named: the columns that a grant is limited to."""
    grants = F.filter(_items("policyItems"), _reads)
    access = F.coalesce("policyType", F.lit(ACCESS)) == ACCESS
    none = F.array().cast("array<string>")
    v, reads, kind = F.array_distinct(F.transform(_values("column"), lambda x: F.lower(x))), F.size(grants) > 0, F.coalesce("policyType", F.lit(ACCESS))
    return policies.where(F.col("isEnabled")).select(
        (kind == ROW_FILTER).alias("filtered"), (kind == MASKING).alias("masked"), (F.size(_items("denyPolicyItems")) > 0).alias("denies"), (column_scoped() & reads).alias("scoped"),
        F.when(access, _groups(grants)).otherwise(none).alias("granted"), F.when(access, _groups(_items("allowExceptions"))).otherwise(none).alias("excepted"),
        (access & F.coalesce("isDenyAllElse", F.lit(False))).alias("deny_all_else"), F.when((F.size(v) > 0) & ~F.array_contains(v, "*") & reads & access, v).alias("named"), *_patterns(),
    )


_PATTERNS = ["database_like", "table_like", "path_like", "path_wide", "path_narrow", "database_values", "table_values", "path_values", "database_excludes", "table_excludes", "path_excludes"]
_FLAGS = ["filtered", "masked", "denies", "scoped"]


def _classes(policies: DataFrame) -> DataFrame:
    """One row for all policies of the same patterns, under an id of its own: they meet the same resources, so
    what they say together is settled once and not at every resource.

    filtered, masked, denies and scoped hold if one of them says so; granted and excepted are their groups; only
    is what each that denies all others leaves (null: none of them does), named the columns that all of those
    which name columns name (null: none does). Groups and columns are counted as rows before any is listed,
    so a class holds as many as there are distinct ones, however many policies it stands for. Written, so that
    the policies are read once.
    """
    marks = lambda role, c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda g: _mark(role, g))
    once = lambda role, c: F.when(c, F.array(_mark(role, F.lit("")))).otherwise(F.array().cast(_MARKS))
    own = F.when(F.col("deny_all_else"), F.array_except("granted", "excepted"))
    every = F.concat(
        F.array(_mark("policy", F.lit(""))), marks("granted", F.col("granted")), marks("excepted", F.col("excepted")), marks("only", own), marks("named", F.col("named")),
        once("onlys", F.col("deny_all_else")), once("nameds", F.col("named").isNotNull()),
    )
    flags = [F.bool_or(n).alias(n) for n in _FLAGS]
    d = _prepared(policies).select(*_PATTERNS, *_FLAGS, F.explode(every).alias("m")).groupBy(*_PATTERNS, "m.role", "m.value").agg(F.count("*").alias("n"), *flags)
    listed = lambda role: F.array_sort(F.collect_list(F.when(F.col("role") == role, F.col("value")))).alias(role)
    counted = lambda role: F.collect_list(F.when(F.col("role") == role, F.struct("value", "n"))).alias(role)
    number = lambda role: F.max(F.when(F.col("role") == role, F.col("n"))).alias(role)
    d = d.groupBy(*_PATTERNS).agg(*flags, listed("granted"), listed("excepted"), counted("only"), counted("named"), number("onlys"), number("nameds"))
    of_all = lambda role: F.when(F.col(f"{role}s").isNotNull(), F.transform(F.filter(role, lambda x: x["n"] == F.col(f"{role}s")), lambda x: x["value"])).alias(role)
    d = d.select(*_PATTERNS, *_FLAGS, "granted", "excepted", of_all("only"), of_all("named"), F.monotonically_increasing_id().alias("id"))
    return written(d, "policies")


_MARKS = "array<struct<role: string, value: string>>"


def _mark(role: str, value: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), value.alias("value"))


def _small(d: DataFrame) -> DataFrame:
    """Broadcast up to a checked number of rows; beyond it both sides of an equi-join are shuffled."""
    return F.broadcast(d) if d.limit(MAX_BROADCAST_POLICIES + 1).count() <= MAX_BROADCAST_POLICIES else d


# --- the index of patterns -----------------------------------------------------------------------


def _plain(c: Column) -> Column:
    """A-Z in lower case, no other letter: the case that the expressions ignore."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _key(how: str | Column, value: Column) -> Column:
    return F.struct((F.lit(how) if isinstance(how, str) else how).alias("how"), value.alias("value"))


def _place(value: Column) -> Column:
    """Where a pattern stands in the index: a literal whole; one with wildcards under its literal head, else
    under its literal tail; one without either under nothing, where all names meet it."""
    head, tail = F.regexp_extract(value, r"^([^*?]*)", 1), F.regexp_extract(value, r"([^*?]*)$", 1)
    return F.when(head == value, _key("is", value)).when(head != "", _key("head", head)).when(tail != "", _key("tail", tail)).otherwise(_key("any", F.lit("")))


def _entries_of(policies: DataFrame, *names: str) -> DataFrame:
    """id, name, how, value: of every policy the patterns of one resource, the first of the names of which
    none stands under nothing, or else the first."""
    places = lambda n: F.when(F.col(f"{n}_excludes"), F.array(_key("any", F.lit("")))).otherwise(F.transform(F.col(f"{n}_values"), _place))
    d = policies.select("id", *(places(n).alias(n) for n in names))
    whole = [F.size(n) == 0 for n in names]  # no values meet nothing
    close = [~F.exists(n, lambda p: p["how"] == "any") for n in names]
    pick = F.lit(names[0])
    for n, w, c in reversed(list(zip(names, whole, close))):
        pick = F.when(c & ~w, F.lit(n)).otherwise(pick)
    met = ~whole[0]
    for w in whole[1:]:
        met = met & ~w
    chosen = F.coalesce(*(F.when(pick == n, F.col(n)) for n in names))
    return d.where(met).select("id", pick.alias("name"), F.explode(chosen).alias("p")).select("id", "name", "p.how", "p.value").distinct()


def _probes(entries: DataFrame, name: str, candidate: Column) -> Column:
    """What a name asks the index for: itself, its heads and tails of the lengths that patterns have, and
    nothing. Only those lengths reach the driver."""
    rows = entries.where(F.col("name") == name).groupBy("how").agg(F.sort_array(F.collect_set(F.char_length("value"))).alias("lengths")).collect()
    asked = []
    for how, lengths in sorted((r["how"], r["lengths"]) for r in rows):
        if how in ("is", "any"):
            asked.append(F.array(_key(how, candidate if how == "is" else F.lit(""))))
            continue
        fits = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length(candidate))
        if how == "head":
            asked.append(F.transform(fits, lambda n: _key("head", F.substring(candidate, F.lit(1), n))))
        else:
            asked.append(F.transform(fits, lambda n: _key("tail", F.substring(candidate, F.char_length(candidate) - n + 1, n))))
    return F.concat(*asked) if asked else F.array().cast("array<struct<how: string, value: string>>")


def _met(resources: DataFrame, policies: DataFrame, condition: Column, names: dict[str, Column]) -> DataFrame:
    """Every resource, once without a policy and once beside each that the condition says it meets.

    names: the columns of a resource's names as patterns see them. Distinct resources meet the index by
    equality, are then joined with the policies found by id, and only those pairs are held against the
    expressions. A policy here is a class of policies (_classes).
    """
    ready = _classes(policies)
    keys, distinct = resources.columns, resources.distinct()
    entries = _entries_of(ready, *names)
    asked = [distinct.select(*keys, F.lit(n).alias("name"), F.explode(_probes(entries, n, c)).alias("p")) for n, c in names.items()]
    d = asked[0]
    for x in asked[1:]:
        d = d.unionByName(x)
    d = d.select(*keys, "name", "p.how", "p.value").join(_small(entries), ["name", "how", "value"]).select(*keys, "id").distinct()
    found = d.join(_small(ready), "id").where(condition)
    return resources.unionByName(found, allowMissingColumns=True)


def _decided(met: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Flags and surviving groups of each resource over the policies that it met, and more aggregates.

    Groups that any policy excepts go; each policy that denies all others then keeps only its own.
    """
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    d = met.groupBy(*keys).agg(
        some("filtered").alias("filtered"), some("masked").alias("masked"), some("denies").alias("denied"), some("scoped").alias("scoped"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("granted")))).alias("granted"), F.flatten(F.collect_set("excepted")).alias("excepted"),
        F.collect_set("only").alias("only"), *more,
    )
    left = F.aggregate("only", F.array_except("granted", "excepted"), lambda a, b: F.array_intersect(a, b))
    return d.withColumn("groups", left)


def _tables_met(tables: DataFrame, policies: DataFrame) -> DataFrame:
    names = {n: _plain(F.col(n)) for n in ("table", "database")}
    return _met(tables.select("database", "table"), policies, covers("database", F.col("database")) & covers("table", F.col("table")), names)


def route_tables(tables: DataFrame, policies: DataFrame) -> DataFrame:
    """database, table, verdict (index or live query), reason, groups. The first reason that holds
    decides: a row filter, a mask, a deny, a grant of some columns, no group at all."""
    d = _decided(_tables_met(tables, policies), ["database", "table"])
    reason = F.when(F.col("filtered"), "row filter").when(F.col("masked"), "mask").when(F.col("denied"), "deny").when(F.col("scoped"), "column grant").when(F.size("groups") == 0, "no group")
    return _routed(d.withColumn("reason", reason), ["database", "table"])


def route_catalogue(tables: DataFrame, policies: DataFrame) -> DataFrame:
    """The same for catalogue entries of tables: a filter or mask of the rows doesn't hide the entry."""
    d = _decided(_tables_met(tables, policies), ["database", "table"])
    return _routed(d.withColumn("reason", F.when(F.col("denied"), "deny").when(F.size("groups") == 0, "no group")), ["database", "table"])


def route_databases(databases: DataFrame, policies: DataFrame) -> DataFrame:
    d = _decided(_met(databases.select("database"), policies, covers("database", F.col("database")), {"database": _plain(F.col("database"))}), ["database"])
    return _routed(d.withColumn("reason", F.when(F.col("denied"), "deny").when(F.size("groups") == 0, "no group")), ["database"])


def route_paths(paths: DataFrame, policies: DataFrame) -> DataFrame:
    """Paths: a deny anywhere above refuses; without any matching grant the file's own mask decides."""
    found = _paths_met(paths.select("path"), policies)
    deny = F.coalesce(F.bool_or("_deny"), F.lit(False)).alias("_deny")
    granted = {n: F.when(F.col("_grants"), F.col(n)) for n in (*_FLAGS, "granted", "excepted", "only")}
    d = _decided(found.withColumns({"_deny": F.col("_denies") & F.col("denies")} | granted), ["path"], deny)
    return _routed(d.withColumn("reason", F.when(F.col("_deny"), "deny")), ["path"])


def _paths_met(paths: DataFrame, policies: DataFrame) -> DataFrame:
    """As _met, with _grants and _denies: whether the policy takes the path, and whether it would as a deny.

    A path without wildcards stands in the index whole. Every path asks for itself and all directories
    above it, so what a recursive policy or a deny reaches is found by equality as well.
    """
    at, grants, denies = _trimmed(F.col("path")), covers_path(F.col("path")), covers_path_for_deny(F.col("path"))
    ready = _classes(policies)
    whole = F.transform("path_values", lambda v: F.when(v.rlike("[*?]"), _place(v)).otherwise(_key("under", _trimmed(v))))
    places = F.when(F.col("path_excludes") & (F.size("path_values") > 0), F.array(_key("any", F.lit("")))).otherwise(whole)
    entries = ready.select("id", F.explode(places).alias("p")).select("id", F.lit("path").alias("name"), "p.how", "p.value").distinct()
    distinct = paths.distinct()
    asked = F.concat(_probes(entries.where("how <> 'under'"), "path", at), F.transform(_with_above(at), lambda x: _key("under", x)))
    d = distinct.select("path", F.lit("path").alias("name"), F.explode(asked).alias("p")).select("path", "name", "p.how", "p.value")
    d = d.join(_small(entries), ["name", "how", "value"]).select("path", "id").distinct().join(_small(ready), "id")
    d = d.withColumns({"_grants": grants, "_denies": denies}).where("_grants or _denies")
    return paths.withColumns({"_grants": F.lit(True), "_denies": F.lit(False)}).unionByName(d, allowMissingColumns=True)


def _above(path: Column) -> Column:
    """The directories above a path, from the top down."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.when(n == 1, F.lit("/")).otherwise(F.array_join(F.slice(parts, 1, n), "/")))


def _with_above(path: Column) -> Column:
    return F.array_distinct(F.concat(_above(path), F.array(path)))


def _routed(d: DataFrame, keys: list[str]) -> DataFrame:
    out = F.col("reason").isNotNull()
    return d.select(*keys, F.when(out, "live query").otherwise("index").alias("verdict"), "reason", F.when(out, F.array().cast("array<string>")).otherwise(F.col("groups")).alias("groups"))


def describable_columns(tables: DataFrame, policies: DataFrame) -> DataFrame:
    """database, table, columns: those that every granting policy which names columns names; null: all."""
    d = _tables_met(tables, policies).groupBy("database", "table").agg(F.collect_set("named").alias("_lists"))
    both = F.aggregate("_lists", F.get("_lists", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    return d.select("database", "table", F.when(F.size("_lists") > 0, F.array_sort(both)).alias("columns"))


# --- POSIX masks ---------------------------------------------------------------------------------


def permission_bit(permission: Column, place: int, bit: int) -> Column:
    """A bit (4 read, 1 execute) of the owner's (0), group's (1) or others' (2) octal digit; no bit if
    the permission isn't octal."""
    p = F.lpad(permission, 3, "0")
    digit = F.substring(F.substring(p, -3, 3), place + 1, 1).cast("int")
    return F.when(permission.rlike("^[0-7]+$"), digit.bitwiseAND(F.lit(bit)) != 0).otherwise(F.lit(False))


def _entries(acl: Column) -> Column:
    """Access entries as parts; entries that new files inherit grant nothing."""
    split = F.transform(F.filter(F.coalesce(acl, F.array().cast("array<string>")), lambda e: ~F.lower(e).startswith("default:")), lambda e: F.split(e, ":"))
    return F.filter(split, lambda p: F.size(p) == 3)


def _named(acl: Column, letter: str) -> Column:
    hit = F.filter(_entries(acl), lambda p: (F.lower(p[0]) == "group") & (p[1] != "") & p[2].contains(letter))
    return F.transform(hit, lambda p: p[1])


def _with_bit(permission: Column, acl: Column, group: Column, bit: int, letter: str) -> Column:
    mask = permission_bit(permission, 1, bit)
    extended = F.exists(F.coalesce(acl, F.array().cast("array<string>")), lambda e: ~F.lower(e).startswith("default:"))
    entry = F.get(F.filter(_entries(acl), lambda p: (F.lower(p[0]) == "group") & (p[1] == "")), F.lit(0))
    own = F.when(extended, mask & F.coalesce(entry[2].contains(letter), F.lit(False))).otherwise(mask)
    none = F.array().cast("array<string>")
    owner = F.when(own & (F.trim(F.coalesce(group, F.lit(""))) != ""), F.array(group)).otherwise(none)
    return F.array_distinct(F.concat(owner, F.when(mask, _named(acl, letter)).otherwise(none)))


def read_groups(permission: Column, acl: Column, group: Column) -> Column:
    """Groups that may read: with an extended ACL the mask limits the owning and the named groups."""
    return _with_bit(permission, acl, group, 4, "r")


def traverse_groups(permission: Column, acl: Column, group: Column) -> Column:
    """Groups that may pass through a directory."""
    return _with_bit(permission, acl, group, 1, "x")


def folder_gates(folders: DataFrame, directories: DataFrame) -> DataFrame:
    """path, gate and everyone of each of the folders (path) and all above them, the folder itself included:
    groups that may pass all of them (null: all) and whether others may. A directory that others may pass,
    or that is unknown, doesn't narrow the gate.

    The fold goes down the tree level by level over distinct directories: each meets its parent by one
    equi-join, so no directory meets more rows than it has children. There are as many joins as levels;
    every level but the last is written, which keeps the plan of each to one join.
    """
    known = directories.select(
        "path", permission_bit(F.col("permission"), 2, 1).alias("_world"),
        F.transform(traverse_groups(F.col("permission"), F.col("acl"), F.col("group")), lambda g: F.lower(g)).alias("_groups"),
    )
    tree = folders.select(F.explode(_with_above(F.col("path"))).alias("path")).distinct().join(known, "path", "left")
    depth = F.when(F.col("path") == "/", 0).otherwise(F.size(F.split("path", "/")) - 1)
    tree = written(tree.withColumn("_depth", depth), "folders")
    deepest = tree.agg(F.max("_depth")).first()[0]
    own = F.when(~F.coalesce("_world", F.lit(True)), F.col("_groups"))
    every, up = None, None
    for k in range((deepest if deepest is not None else -1) + 1):
        d = tree.where(F.col("_depth") == k).select("path", own.alias("_own"))
        if up is None:
            d = d.select("path", F.col("_own").alias("gate"), F.col("_own").isNull().alias("everyone"))
        else:
            above = F.element_at(_above(F.col("path")), -1)
            d = d.withColumn("_up", above).join(up.select(F.col("path").alias("_up"), "gate", "everyone"), "_up")
            gate = F.when(F.col("gate").isNull(), F.col("_own")).when(F.col("_own").isNull(), F.col("gate")).otherwise(F.array_intersect("gate", "_own"))
            d = d.select("path", gate.alias("gate"), (F.col("everyone") & F.col("_own").isNull()).alias("everyone"))
        up = d if k == deepest else written(d, "gates")
        every = up if every is None else every.unionByName(up)
    return tree.limit(0).select("path", F.array().cast("array<string>").alias("gate"), F.lit(True).alias("everyone")) if every is None else every


def traverse_gates(files: DataFrame, directories: DataFrame) -> DataFrame:
    """files with gate (groups that may pass every directory above; null: all) and everyone (whether
    others may). Folds over distinct folders (folder_gates), then one equi-join on the file's folder."""
    d = files.withColumn("_folder", F.element_at(_above(F.col("path")), -1))
    gates = folder_gates(d.select(F.col("_folder").alias("path")).distinct(), directories).withColumnRenamed("path", "_folder")
    return d.join(gates, "_folder", "left").drop("_folder").withColumn("everyone", F.coalesce("everyone", F.lit(True)))


def file_grants(files: DataFrame, principals: DataFrame, other_group: str | None = None) -> DataFrame:
    """path and acl of files (path, permission, acl, group, gate, everyone, policy_groups): groups that
    may read and pass, and those that policies grant, as principals (group, object_id); and other_group
    where anyone may read. An unknown group grants nothing. An empty acl means refuse."""
    none = F.array().cast("array<string>")
    lower = lambda c: F.transform(c, lambda g: F.lower(g))
    own = lower(read_groups(F.col("permission"), F.col("acl"), F.col("group")))
    reach = F.when(F.col("gate").isNull(), own).otherwise(F.array_intersect(own, lower(F.col("gate"))))
    groups = F.array_distinct(F.concat(reach, lower(F.coalesce("policy_groups", none))))
    world = permission_bit(F.col("permission"), 2, 4) & F.col("everyone")
    d = files.select("path", groups.alias("_groups"), world.alias("_world"))
    known = principals.where("object_id is not null").select(F.lower("group").alias("_g"), "object_id")
    found = d.select("path", F.explode("_groups").alias("_g")).join(known, "_g").groupBy("path").agg(F.collect_set("object_id").alias("_ids"))
    extra = F.when(F.col("_world") & F.lit(bool(other_group)), F.array(F.lit(other_group or ""))).otherwise(none)
    return d.join(found, "path", "left").select("path", F.array_sort(F.array_union(F.coalesce("_ids", none), extra)).alias("acl"))


def resolved_acl(acl: Column, default: Column) -> Column:
    """struct(acl, refused): null takes the default, empty is refused; ids are lower-case and distinct."""
    a = F.array_distinct(F.transform(F.coalesce(acl, default), lambda x: F.lower(F.trim(x))))
    return F.struct(a.alias("acl"), (F.coalesce(F.size(a), F.lit(0)) == 0).alias("refused"))


# --- sensitivity ---------------------------------------------------------------------------------


def sensitivity(classifications: Column, labels: list[dict], *, mode: str = "enforce", unmapped: str = "index", unlabelled: str = "index") -> Column:
    """struct(label, refused, why) of an array of tags.

    labels: name, tags and indexable of each, least restrictive first; the most restrictive label of
    the tags wins. mode: off, annotate or enforce; only the last refuses: unlabelled or unmapped items
    where those are "refuse", and labels that aren't indexable.
    """
    if mode not in ("off", "annotate", "enforce"):
        raise ValueError("mode is off, annotate or enforce")
    names = [x["name"] for x in labels]
    owner: dict[str, int] = {}
    for rank, label in enumerate(labels):
        for tag in label["tags"]:
            if owner.setdefault(tag.strip().lower(), rank) != rank:
                raise ValueError(f"tag {tag} belongs to two labels")
    if len(set(names)) != len(names):
        raise ValueError("label names repeat")
    nothing = F.struct(F.lit(None).cast("string").alias("label"), F.lit(False).alias("refused"), F.lit(None).cast("string").alias("why"))
    if mode == "off" or not labels:
        return nothing
    tags = F.filter(F.transform(F.coalesce(classifications, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t))), lambda t: F.coalesce(t, F.lit("")) != "")
    ranks = F.create_map(*(F.lit(x) for kv in owner.items() for x in kv)) if owner else F.create_map().cast("map<string,int>")
    winner = F.array_max(F.transform(tags, lambda t: F.coalesce(ranks[t], F.lit(-1))))
    enforce = mode == "enforce"
    refuse = lambda label, why: F.struct(label.alias("label"), F.lit(True).alias("refused"), F.lit(why).alias("why"))
    none = F.lit(None).cast("string")
    label = F.get(F.array(*map(F.lit, names)), winner)
    closed = ~F.get(F.array(*(F.lit(bool(x.get("indexable", True))) for x in labels)), winner)
    return (
        F.when((F.size(tags) == 0) & F.lit(enforce and unlabelled == "refuse"), refuse(none, "unlabelled"))
        .when(F.size(tags) == 0, nothing)
        .when(F.exists(tags, lambda t: ranks[t].isNull()) & F.lit(enforce and unmapped == "refuse"), refuse(none, "unmapped"))
        .when(winner < 0, nothing)
        .when(closed & F.lit(enforce), refuse(label, "label not indexable"))
        .otherwise(F.struct(label.alias("label"), F.lit(False).alias("refused"), none.alias("why")))
    )


# --- lineage -------------------------------------------------------------------------------------


def lineage_neighbours(entities: DataFrame, edges: DataFrame, steps: int = 2) -> DataFrame:
    """guid, direction, neighbour: data entities reached through transformation nodes only.

    entities: guid, is_process, qualified_name; edges: from_id, to_id. A walk goes on through processes
    and ends at data; steps bounds the number of joins, each on the node's id.
    """
    kind = entities.select(F.col("guid").alias("node"), "is_process", "qualified_name")
    out = None
    for direction, a, b in (("downstream", "from_id", "to_id"), ("upstream", "to_id", "from_id")):
        step = edges.select(F.col(a).alias("at"), F.col(b).alias("node")).distinct()
        front = entities.where(~F.col("is_process")).select("guid", F.col("guid").alias("at"))
        for _ in range(steps):
            met = front.join(step, "at").select("guid", "node").distinct().join(kind, "node")
            data = met.where(~F.col("is_process") & (F.col("node") != F.col("guid"))).select("guid", F.lit(direction).alias("direction"), F.col("node").alias("neighbour"), "qualified_name")
            out = data if out is None else out.unionByName(data)
            front = met.where("is_process").select("guid", F.col("node").alias("at"))
    return out.dropDuplicates(["guid", "direction", "neighbour"])


def visible_neighbours(neighbours: DataFrame, grants: DataFrame) -> DataFrame:
    """guid, direction, names: neighbours that everyone who may see the entity may see, too; names alike
    but for case count once. grants: guid, groups."""
    g = grants.select("guid", F.transform("groups", lambda x: F.lower(x)).alias("groups"))
    d = neighbours.join(g.withColumnRenamed("groups", "own"), "guid").join(g.select(F.col("guid").alias("neighbour"), F.col("groups").alias("theirs")), "neighbour")
    d = d.where(F.size(F.array_except("own", "theirs")) == 0)
    d = d.groupBy("guid", "direction", F.lower("qualified_name").alias("_k")).agg(F.min("qualified_name").alias("name"))
    return d.groupBy("guid", "direction").agg(F.array_sort(F.collect_list("name")).alias("names"))
