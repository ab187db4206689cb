"""Files that readers open by themselves, in part: addresses as Spark writes them, through pyarrow's file systems."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the path within it; `file:/x`, as Spark names local files, is `file:///x`."""
    if "://" not in path:
        path = path.replace("file:", "", 1) if path.startswith("file:") else path
        path = f"file://{path}"
    return fs.FileSystem.from_uri(path)


def sizes(folder: str, suffix: str = "") -> dict[str, int]:
    """Size of each file of a folder, by its name within it; hidden and unfinished ones are left out."""
    store, at = opened(folder)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True))
    inside = {f.path[len(at) :].lstrip("/"): f.size for f in found if f.type == fs.FileType.File}
    return {k: v for k, v in inside.items() if k.endswith(suffix) and not any(x.startswith((".", "_")) for x in k.split("/"))}


def content(path: str) -> bytes | None:
    """A whole small file, or None where there is none."""
    store, at = opened(path)
    if store.get_file_info(at).type != fs.FileType.File:
        return None
    with store.open_input_stream(at, compression=None) as f:
        return f.read()


def put(path: str, body: bytes) -> None:
    store, at = opened(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at, compression=None) as f:
        f.write(body)
