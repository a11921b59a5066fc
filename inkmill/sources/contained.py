"""Files and folders below a root that are reached without following a link.

Every part of a path is opened from the folder above it, and not by name from the root, so that a link, or a folder that is
replaced meanwhile, can't lead elsewhere.  The root itself may be reached through links: it is what the caller named.
"""

from __future__ import annotations

import errno
import fcntl
import hashlib
import os
import shutil
import stat
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

CHUNK = 1 << 20
_FOLDER = os.O_RDONLY | os.O_DIRECTORY
_NO_LINK = os.O_NOFOLLOW | os.O_CLOEXEC


class Unsafe(ValueError):
    """A path that leads, or may lead, out of its root."""


def parts(rel: str) -> list[str]:
    """Components of a relative path; Unsafe for any path that ``functions.names.safe`` refuses."""
    own = rel.replace("\\", "/").split("/")
    if "\0" in rel or any(p in ("", ".", "..") for p in own) or own[0][1:2] == ":" and own[0][0].isalpha() and own[0][0].isascii():
        raise Unsafe(f"unsafe path: {rel}")
    return own


def _enter(fd: int, name: str, rel: str) -> int:
    try:
        return os.open(name, _FOLDER | _NO_LINK, dir_fd=fd)
    except OSError as e:
        if e.errno in (errno.ELOOP, errno.ENOTDIR):
            raise Unsafe(f"a link or a file in place of a folder: {rel}") from e
        raise


@contextmanager
def folder(root: str, rel: str = "", create: bool = False) -> Iterator[int]:
    """A descriptor of the folder ``rel`` of ``root``; FileNotFoundError if it isn't there and is not to be made, root and all."""
    if create:
        os.makedirs(root, exist_ok=True)
    fd = os.open(root, _FOLDER | os.O_CLOEXEC)
    try:
        for name in parts(rel) if rel else []:
            if create:
                with suppress(FileExistsError):
                    os.mkdir(name, dir_fd=fd)
            below = _enter(fd, name, rel)
            os.close(fd)
            fd = below
        yield fd
    finally:
        os.close(fd)


@contextmanager
def _place(root: str, rel: str, create: bool = False) -> Iterator[tuple[int, str]]:
    """The folder of a path, and its last component."""
    *above, name = parts(rel)
    with folder(root, "/".join(above), create) as fd:
        yield fd, name


def kind(root: str, rel: str) -> str | None:
    """``file`` or ``folder``; None if nothing is there; Unsafe for anything else, or behind a link."""
    try:
        with _place(root, rel) as (fd, name):
            mode = os.stat(name, dir_fd=fd, follow_symlinks=False).st_mode
    except FileNotFoundError:
        return None
    if stat.S_ISREG(mode):
        return "file"
    if stat.S_ISDIR(mode):
        return "folder"
    raise Unsafe(f"a link, or neither a file nor a folder: {rel}")


@contextmanager
def writer(root: str, rel: str) -> Iterator:
    """A binary file that takes the place of ``rel`` when the block ends, and not at all if it fails: no reader sees half of it."""
    with _place(root, rel, create=True) as (fd, name):
        part = f".{uuid.uuid4().hex}.part"
        out = os.open(part, os.O_WRONLY | os.O_CREAT | os.O_EXCL | _NO_LINK, 0o666, dir_fd=fd)
        try:
            with os.fdopen(out, "wb") as f:
                yield f
                f.flush()
                os.fsync(f.fileno())
            os.replace(part, name, src_dir_fd=fd, dst_dir_fd=fd)
        except BaseException:
            with suppress(FileNotFoundError):
                os.unlink(part, dir_fd=fd)
            raise


def write(root: str, rel: str, data: bytes) -> None:
    with writer(root, rel) as f:
        f.write(data)


@contextmanager
def reader(root: str, rel: str) -> Iterator:
    """A regular file to read; FileNotFoundError, or Unsafe for a link or something else."""
    with _place(root, rel) as (fd, name):
        try:
            source = os.open(name, os.O_RDONLY | os.O_NONBLOCK | _NO_LINK, dir_fd=fd)
        except OSError as e:
            if e.errno == errno.ELOOP:
                raise Unsafe(f"a link in place of a file: {rel}") from e
            raise
        with os.fdopen(source, "rb") as f:
            if not stat.S_ISREG(os.fstat(f.fileno()).st_mode):
                raise Unsafe(f"not a file: {rel}")
            yield f


def read(root: str, rel: str) -> bytes:
    with reader(root, rel) as f:
        return f.read()


def digest(root: str, rel: str) -> tuple[str, int]:
    """SHA-256 and size, read in chunks; OSError if the file changes meanwhile."""
    with reader(root, rel) as f:
        before, h, size = os.fstat(f.fileno()), hashlib.sha256(), 0
        while chunk := f.read(CHUNK):
            h.update(chunk)
            size += len(chunk)
        after = os.fstat(f.fileno())
        if (before.st_size, before.st_mtime_ns) != (after.st_size, after.st_mtime_ns) or size != after.st_size:
            raise OSError(f"the file changed while it was read: {rel}")
        return h.hexdigest(), size


def unlink(root: str, rel: str) -> None:
    with _place(root, rel) as (fd, name):
        os.unlink(name, dir_fd=fd)


def move(root: str, old: str, new: str) -> None:
    """Rename within the root; folders above the new place are made.  What is there must not be a folder with contents."""
    with _place(root, old) as (a, name), _place(root, new, create=True) as (b, to):
        os.rename(name, to, src_dir_fd=a, dst_dir_fd=b)


def remove_tree(root: str, rel: str) -> None:
    """Delete a folder and what is in it, if it is there; links in it go, not what they point to."""
    if kind(root, rel) == "folder":
        with _place(root, rel) as (fd, name):
            shutil.rmtree(name, dir_fd=fd)


def entries(root: str, rel: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    try:
        with folder(root, rel) as fd:
            return sorted(os.listdir(fd))
    except FileNotFoundError:
        return []


@contextmanager
def locked(root: str, rel: str) -> Iterator[None]:
    """Holds a lock file; RuntimeError if another process has it.  It goes with the process that holds it."""
    with _place(root, rel, create=True) as (fd, name):
        lock = os.open(name, os.O_RDWR | os.O_CREAT | _NO_LINK, 0o666, dir_fd=fd)
        try:
            try:
                fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError as e:
                raise RuntimeError(f"another process holds {rel}") from e
            yield
        finally:
            os.close(lock)
