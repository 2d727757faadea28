"""A plain per-log decoder for static one-word types, to check the expressions against."""

from logloom.operators.decode import BAD_TOPIC, NOT_DECODED
from logloom.registry import DEFAULT

ROUTES = {
    (contract, d.topic0): d for protocol in DEFAULT.protocols for contract, defs in protocol for d in defs
}
HEX = set("0123456789abcdefABCDEF")


class Bad(Exception):
    pass


def _width(kind, prefix, default):
    return int(kind[len(prefix):] or default)


def topic_value(topic, kind):
    word = topic.removeprefix("0x").lower().rjust(64, "0")
    if kind == "address":
        return "0x" + word[-40:]
    if kind.startswith("bytes"):
        return "0x" + word[: 2 * _width(kind, "bytes", 32)]
    if kind not in ("bool",) and not kind.startswith(("uint", "int")):
        return "0x" + word
    if not set(word) <= HEX:
        raise Bad
    value = int(word, 16)
    if kind == "bool":
        return str(value != 0)
    if kind.startswith("int") and value >> (_width(kind, "int", 256) - 1):
        value -= 1 << _width(kind, "int", 256)
    return str(value)


def data_value(word, kind):
    value = int.from_bytes(word, "big")
    if kind == "address":
        if word[:12].strip(b"\0"):
            raise Bad
        return "0x" + word[12:].hex()
    if kind == "bool":
        if value > 1:
            raise Bad
        return str(value == 1)
    if kind.startswith("uint"):
        if value >> _width(kind, "uint", 256):
            raise Bad
        return str(value)
    if kind.startswith("int"):
        bits = _width(kind, "int", 256)
        signed = value - (1 << 256) if value >> 255 else value
        if not -(1 << (bits - 1)) <= signed < 1 << (bits - 1):
            raise Bad
        return str(signed)
    size = _width(kind, "bytes", 32)
    if word[size:].strip(b"\0"):
        raise Bad
    return "0x" + word[:size].hex()


def decode(address, topics, data):
    """(payload, None) or (None, error)."""
    definition = ROUTES.get((address.lower(), topics[0].lower())) if topics else None
    if definition is None:
        return None, NOT_DECODED
    payload = {
        "_event": definition.event,
        "_version": definition.version,
        "_contract": address.lower(),
        "_protocol": definition.protocol,
    }
    for position, (name, kind) in enumerate(definition.topic_fields, 1):
        try:
            if position >= len(topics):
                payload[name] = None
            elif topics[position] is None:
                raise Bad
            else:
                payload[name] = topic_value(topics[position], kind)
        except Bad:
            return None, BAD_TOPIC.format(position)
    body = (data or "").removeprefix("0x")
    if not set(body) <= HEX or len(body) % 2 or len(body) < 64 * len(definition.data_fields):
        return None, NOT_DECODED
    raw = bytes.fromhex(body)
    try:
        for i, (name, kind) in enumerate(definition.data_fields):
            payload[name] = data_value(raw[32 * i : 32 * i + 32], kind)
    except Bad:
        return None, NOT_DECODED
    return payload, None
