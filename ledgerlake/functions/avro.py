"""Minimal Avro binary codec, message by message: the encoder, and a plain decoder
that the column-wise one (``resolve``) is tested against.  Bad bodies raise
``AvroError``.
"""

from __future__ import annotations

import json
import struct

PRIMITIVES = {"null", "boolean", "int", "long", "float", "double", "bytes", "string"}

_D = struct.Struct("<d")
_F = struct.Struct("<f")


class AvroError(ValueError):
    pass


def _known(t, names: dict):
    """A type as a primitive's name or, resolved, as a definition."""
    if isinstance(t, str):
        if t in PRIMITIVES:
            return t
        if t in names:
            return names[t]
    elif isinstance(t, dict):
        kind = t.get("type")
        if kind in PRIMITIVES or isinstance(kind, dict):
            return _known(kind, names)              # logical types are read as what they are stored as
        if kind in ("enum", "fixed", "record"):
            names[t.get("name")] = t
            return t
        if kind in ("array", "map"):
            return t
    raise AvroError(f"unsupported type {t!r}")


def parse_schema(schema_json: str | dict) -> list[tuple[str, tuple, object]]:
    """Record schema -> [(field, branch types, default)].  A plain type is a
    one-branch union; a branch is a primitive's name or a definition."""
    s = json.loads(schema_json) if isinstance(schema_json, str) else schema_json
    if not isinstance(s, dict) or s.get("type") != "record":
        raise AvroError("top-level schema must be a record")
    names: dict = {}
    return [(f["name"], tuple(_known(b, names) for b in (f["type"] if isinstance(f["type"], list) else [f["type"]])),
             f.get("default")) for f in s["fields"]]


def _read_long(buf: bytes, pos: int) -> tuple[int, int]:
    shift = 0
    acc = 0
    n = len(buf)
    while True:
        if pos >= n:
            raise AvroError("truncated varint")
        b = buf[pos]
        pos += 1
        acc |= (b & 0x7F) << shift
        if not b & 0x80:
            break
        shift += 7
        if shift > 63:
            raise AvroError("varint too long")
    return (acc >> 1) ^ -(acc & 1), pos


def decode_record(fields, buf: bytes) -> dict:
    """Decode one record body; trailing bytes are an error."""
    try:
        values = compile_decoder(fields)(buf)
    except (IndexError, struct.error) as e:
        raise AvroError("truncated body") from e
    return {name: v for (name, _, _), v in zip(fields, values)}


def _write_long(n: int, out: bytearray) -> None:
    z = (n << 1) ^ (n >> 63)
    while z & ~0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)


def _fits(kind, v) -> bool:
    if v is None:
        return kind == "null"
    if isinstance(kind, dict):
        return {"enum": lambda: v in kind["symbols"] if isinstance(v, str) else False,
                "fixed": lambda: isinstance(v, (bytes, bytearray)) and len(v) == kind["size"],
                "array": lambda: isinstance(v, (list, tuple)),
                "map": lambda: isinstance(v, (dict, list)), "record": lambda: isinstance(v, dict)}[kind["type"]]()
    if kind == "boolean":
        return isinstance(v, bool)
    if kind in ("int", "long"):
        return isinstance(v, int) and not isinstance(v, bool)
    if kind in ("float", "double"):
        return isinstance(v, (float, int)) and not isinstance(v, bool)
    if kind == "string":
        return isinstance(v, str)
    if kind == "bytes":
        return isinstance(v, (bytes, bytearray))
    return False


def _write_nested(kind: dict, v, out: bytearray) -> None:
    def one(t, value):
        _write_union(tuple(_known(b, {}) for b in (t if isinstance(t, list) else [t])), value, out)

    if kind["type"] == "enum":
        _write_long(kind["symbols"].index(v), out)
    elif kind["type"] == "fixed":
        out += v
    elif kind["type"] == "record":
        for f in kind["fields"]:
            one(f["type"], v.get(f["name"]))
    else:                                            # Arrow gives a map as a list of pairs
        pairs = list(dict(v).items()) if kind["type"] == "map" else [(None, x) for x in v]
        if pairs:
            _write_long(len(pairs), out)
        for key, x in pairs:
            if key is not None:
                _write("string", key, out)
            one(kind["values"] if kind["type"] == "map" else kind["items"], x)
        out.append(0)


def _write_union(branches, v, out: bytearray, name: str = "value") -> None:
    for i, kind in enumerate(branches):
        if _fits(kind, v):
            if len(branches) > 1:
                _write_long(i, out)
            _write(kind, v, out)
            return
    raise AvroError(f"value of {name} fits no branch of {branches}")


def _write(kind, v, out: bytearray) -> None:
    if kind == "null":
        return
    if isinstance(kind, dict):
        _write_nested(kind, v, out)
        return
    if kind == "boolean":
        out.append(1 if v else 0)
    elif kind in ("int", "long"):
        _write_long(int(v), out)
    elif kind == "double":
        out += _D.pack(float(v))
    elif kind == "float":
        out += _F.pack(float(v))
    else:
        raw = v.encode("utf-8") if kind == "string" else bytes(v)
        _write_long(len(raw), out)
        out += raw


def encode_record(fields, record: dict) -> bytes:
    """Encode one record; a value that fits no branch raises AvroError."""
    out = bytearray()
    for name, branches, _ in fields:
        _write_union(branches, record.get(name), out, name)
    return bytes(out)


_SHORT = [bytes([2 * n]) for n in range(64)]         # lengths that take one byte


def encode_values(name: str, branches: tuple, values: list) -> list[bytes | None]:
    """A column's values encoded one by one; None where a value fits no branch."""
    first = next((i for i, b in enumerate(branches) if _fits(b, "") or isinstance(b, dict) and b["type"] == "enum"), None)
    plain = first is not None and branches[first] == "string"
    tag = bytes([2 * first]) if plain and len(branches) > 1 else b""

    def one(v):
        out = bytearray()
        try:
            _write_union(branches, v, out, name)
        except AvroError:
            return None
        return bytes(out)

    def text(v):
        raw = v.encode("utf-8")
        return tag + _SHORT[len(raw)] + raw if len(raw) < 64 else one(v)

    null = one(None)
    return [null if v is None else text(v) if plain and type(v) is str else one(v) for v in values]


# -- compiled decoder: one closure per field, built once per schema --------------
def _long_at(buf, pos):
    b = buf[pos]
    if b < 0x80:                                     # one-byte fast path
        return (b >> 1) ^ -(b & 1), pos + 1
    return _read_long(buf, pos)


def _skipper(kind: dict):
    """A reader past a value of a type that no contract column holds."""
    def one(t):
        names: dict = {}
        return _field_reader(tuple(_known(b, names) for b in (t if isinstance(t, list) else [t])))

    if kind["type"] == "enum":
        symbols = kind["symbols"]

        def rd(buf, pos):
            i, pos = _long_at(buf, pos)
            if not 0 <= i < len(symbols):
                raise AvroError("bad enum index")
            return symbols[i], pos
    elif kind["type"] == "fixed":
        def rd(buf, pos):
            if pos + kind["size"] > len(buf):
                raise AvroError("truncated fixed")
            return None, pos + kind["size"]
    elif kind["type"] == "record":
        readers = [one(f["type"]) for f in kind["fields"]]

        def rd(buf, pos):
            for r in readers:
                _, pos = r(buf, pos)
            return None, pos
    else:
        key = _prim_reader("string") if kind["type"] == "map" else None
        item = one(kind["values" if key else "items"])

        def rd(buf, pos):
            while True:
                n, pos = _long_at(buf, pos)
                if n == 0:
                    return None, pos
                if n < 0:                            # a block with its size: step over it
                    size, pos = _long_at(buf, pos)
                    if size < 0 or pos + size > len(buf):
                        raise AvroError("truncated block")
                    pos += size
                    continue
                for _ in range(n):
                    if key:
                        _, pos = key(buf, pos)
                    _, pos = item(buf, pos)
    return rd


def _prim_reader(kind):
    if isinstance(kind, dict):
        return _skipper(kind)
    if kind == "null":
        return lambda buf, pos: (None, pos)
    if kind == "boolean":
        def rd(buf, pos):
            v = buf[pos]
            if v > 1:
                raise AvroError("bad boolean")
            return v == 1, pos + 1
        return rd
    if kind in ("int", "long"):
        return _long_at
    if kind == "double":
        unpack = _D.unpack_from

        def rd(buf, pos):
            if pos + 8 > len(buf):
                raise AvroError("truncated double")
            return unpack(buf, pos)[0], pos + 8
        return rd
    if kind == "float":
        unpack = _F.unpack_from

        def rd(buf, pos):
            if pos + 4 > len(buf):
                raise AvroError("truncated float")
            return unpack(buf, pos)[0], pos + 4
        return rd
    as_text = kind == "string"

    def rd(buf, pos):
        size, pos = _long_at(buf, pos)
        end = pos + size
        if size < 0 or end > len(buf):
            raise AvroError("truncated bytes")
        raw = buf[pos:end]
        if as_text:
            try:
                return str(raw, "utf-8"), end
            except UnicodeDecodeError as e:
                raise AvroError("bad utf-8") from e
        return bytes(raw), end
    return rd


def _field_reader(branches):
    if len(branches) == 1:
        return _prim_reader(branches[0])
    readers = [_prim_reader(b) for b in branches]
    n = len(readers)

    def rd(buf, pos):
        idx, pos = _long_at(buf, pos)
        if idx < 0 or idx >= n:
            raise AvroError("bad union index")
        return readers[idx](buf, pos)
    return rd


def compile_decoder(fields):
    """Return ``decode(buf) -> list of values`` in field order.  Raises
    AvroError (or IndexError/struct.error on truncation) for a bad body."""
    readers = [_field_reader(b) for _, b, _ in fields]

    def decode(buf):
        pos = 0
        out = []
        append = out.append
        for rd in readers:
            v, pos = rd(buf, pos)
            append(v)
        if pos != len(buf):
            raise AvroError("trailing bytes")
        return out
    return decode
