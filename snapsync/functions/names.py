"""Expressions on object, file and source names."""

from pyspark.sql import Column, functions as F

# Method part types and the file extension of each part.
PART_EXTENSIONS = {
    "EXECUTE": "body",
    "VALIDATE": "validate",
    "PUBLIC": "globals",
    "PRIVATE": "locals",
    "VBSCRIPT": "script",
}
METHOD_PARTS = tuple(PART_EXTENSIONS.values())
# File suffixes of each kind.
KIND_SUFFIXES = {
    "PACKAGE": (".bdy", ".spc"),
    "VIEW": (".sql",),
    "TRIGGER": (".trg.sql",),
    "METHOD": tuple(f".{part}.sql" for part in METHOD_PARTS),
}
PACKAGE_PIECES = ("package", "package body")


def class_after_prefix(table_name: Column) -> Column:
    """The name without its first two characters."""
    return F.substr(table_name, F.lit(3))


def class_after_hash(table_name: Column) -> Column:
    """The name after its first '#', or the whole name."""
    return F.substr(table_name, F.instr(table_name, "#") + 1)


def class_between_hashes(table_name: Column) -> Column:
    """The second '#'-separated piece; null when there is none."""
    return F.get(F.split(table_name, "#"), F.lit(1))


def object_name(file_name: Column) -> Column:
    return F.substring_index(file_name, ".", 1)


def kind_by_pieces(file_name: Column) -> Column:
    """Kind from the next-to-last dot piece, any case; two pieces or fewer make a view."""
    pieces = F.split(file_name, r"\.")
    piece = F.lower(F.element_at(pieces, -2))
    return (
        F.when(F.size(pieces) <= 2, "VIEW")
        .when(piece.isin(*METHOD_PARTS), "METHOD")
        .when(piece.isin(*PACKAGE_PIECES), "PACKAGE")
        .when(piece == "trg", "TRIGGER")
    )


def suffixes(file_name: Column) -> Column:
    """Everything from the first dot that does not lead the name; '' when the name ends in a dot."""
    return F.regexp_extract(file_name, r"^\.*[^.]*(\..*[^.])$", 1)


def kind_by_suffix(file_name: Column) -> Column:
    """Kind from the whole suffix, case-sensitive; anything else is UNKNOWN."""
    kinds = [
        (F.lit(suffix), F.lit(kind)) for kind, known in KIND_SUFFIXES.items() for suffix in known
    ]
    kind_of = F.create_map(*[c for pair in kinds for c in pair])
    return F.coalesce(F.try_element_at(kind_of, suffixes(file_name)), F.lit("UNKNOWN"))


def part_of_file(file_name: Column) -> Column:
    """Method part of a file, or null."""
    return F.nullif(
        F.regexp_extract(file_name, r"\.(%s)\.sql$" % "|".join(METHOD_PARTS), 1), F.lit("")
    )


def file_name(short_name: Column, extention: Column) -> Column:
    dotted = F.concat(F.lit("."), F.coalesce(extention, F.lit("")))
    return F.concat(short_name, F.rtrim(dotted, F.lit(".")), F.lit(".sql"))


def object_path(class_id: Column, short_name: Column, extention: Column) -> Column:
    return F.concat(class_id, F.lit("/"), file_name(short_name, extention))


def object_label(kind: Column, class_id: Column, short_name: Column) -> Column:
    return F.format_string("%s ::[%s].[%s]", F.initcap(kind), class_id, short_name)


def source_label(connection: Column) -> Column:
    """Database part of user/secret@database; null when the text has another form."""
    return F.nullif(F.regexp_extract(connection, "^.+/.+@(.+)$", 1), F.lit(""))


def part_extension(part_type: Column) -> Column:
    extensions = F.create_map(*[F.lit(x) for pair in PART_EXTENSIONS.items() for x in pair])
    return F.try_element_at(extensions, part_type)


def part_types() -> Column:
    """The fixed list of method parts as an array of (type, extention)."""
    return F.array(
        *[
            F.struct(F.lit(kind).alias("type"), F.lit(ext).alias("extention"))
            for kind, ext in PART_EXTENSIONS.items()
        ]
    )
