"""Path expressions: definition paths, model references, export destinations."""

from __future__ import annotations

import posixpath

from tidemark.functions.text import concat, literal

# Kinds in processing order, and where each kind's gated file lives.
KINDS = ("view", "routine", "table", "external", "scheduled", "saved")
DATASET_KINDS = KINDS[:4]
GATED_FILES = {
    "view": ("views", ".sql"),
    "routine": ("routines", ".sql"),
    "table": ("models", ".yaml"),
    "external": ("models", ".yaml"),
    "scheduled": ("scheduled_queries", ".sql"),
    "saved": ("saved_queries", ".sql"),
}
# Kinds that also write a model file, and where.
PAIRED_KINDS = ("view", "routine")
MODEL_FILE = ("models", ".yaml")


def output_root(base: str, output_dir: str, project: str) -> str:
    """``<base>/<output_dir>/<project>``; works for URIs such as ``s3a://…`` as well."""
    scheme, sep, rest = base.partition("://")
    if not sep:
        return posixpath.normpath(posixpath.join(base, output_dir, project))
    if "://" in output_dir:
        return output_root(output_dir, ".", project)
    bucket, _, folder = rest.partition("/")
    inner = posixpath.normpath(posixpath.join("/", folder, output_dir, project))
    return f"{scheme}://{bucket}{inner}"


def definition_path(kind: str, root: str, dataset: str, name: str) -> str:
    """Path whose state decides about the object."""
    cases = []
    for k, (folder, extension) in GATED_FILES.items():
        if k in DATASET_KINDS:
            path = concat(dataset, literal(f"/{folder}/"), name)
        else:
            path = concat(literal(f"{folder}/"), name)
        cases.append(f"WHEN {literal(k)} THEN {below(root, concat(path, literal(extension)))}")
    return f"CASE {kind} {' '.join(cases)} END"


def below(root: str, path: str) -> str:
    """``<root>/<path>``; names are free text, and ``a//b`` or ``a/./b`` is the same file as ``a/b``."""
    return concat(literal(f"{root}/"), f"regexp_replace({path}, r'(?:(?<=/)|^)(?:\\.?/)+', '')")


def is_definition(path: str, root: str | None = None) -> str:
    """Whether a path can be that of a definition file, below ``root`` if given."""
    shape = "rlike(%s, r'/(?:(?:views|routines|scheduled_queries|saved_queries)/.+\\.sql|models/.+\\.yaml)$')" % path
    return shape if root is None else f"(startswith({path}, {literal(root.rstrip('/') + '/')}) AND {shape})"


def model_path(kind: str, root: str, dataset: str, name: str) -> str:
    """Path of the model file written along with views and routines, else null."""
    folder, extension = MODEL_FILE
    path = concat(dataset, literal(f"/{folder}/"), name, literal(extension))
    return f"CASE WHEN {kind} IN {PAIRED_KINDS} THEN {below(root, path)} END"


def basename(path: str) -> str:
    return f"substring_index({path}, '/', -1)"


def stem(name: str) -> str:
    """File name without its last extension; ``.hid`` and ``a.`` have none."""
    cut = f"regexp_replace({name}, r'(?<=[^/])\\.[^./]+\\z', '')"
    return f"CASE WHEN {name} = '.' THEN '' ELSE {cut} END"


def table_ref(project: str, dataset: str, name: str) -> str:
    """``project.dataset.name``."""
    return f"concat_ws('.', {project}, {dataset}, {name})"


def parse_model(model: str) -> str:
    """Struct ``project, dataset, model, error`` of a slash-separated resource path.

    Three segments are project, dataset and name; four have a folder before the
    name. Anything else gives a struct with only ``error`` set.
    """
    parts = f"split({model}, '/', -1)"
    valid = f"size({parts}) IN (3, 4)"
    name = stem(f"get({parts}, size({parts}) - 1)")
    error = concat(
        literal("invalid model path '"),
        model,
        literal("': 3 or 4 segments needed, found "),
        f"CAST(size({parts}) AS STRING)",
    )
    return f"""named_struct(
        'project', CASE WHEN {valid} THEN get({parts}, 0) END,
        'dataset', CASE WHEN {valid} THEN get({parts}, 1) END,
        'model', CASE WHEN {valid} THEN {name} END,
        'error', CASE WHEN NOT {valid} THEN {error} END)"""


def data_dir(folder: str) -> str:
    """Where exports go below an output folder or root."""
    return f"{folder.rstrip('/')}/data"


def export_path(data_dir: str, model: str, fmt: str) -> str:
    """``<data_dir>/<model>.<fmt>``."""
    return concat(literal(f"{data_dir.rstrip('/')}/"), model, literal(f".{fmt}"))
