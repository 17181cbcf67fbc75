"""Date and time patterns with percent signs as Java patterns."""

from __future__ import annotations

_JAVA = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "g": "SSS", "p": "a",
    "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD", "z": "xx", "Z": "zzz", "-d": "d", "-m": "M", "-H": "H", "-I": "h", "-M": "m", "-S": "s", "-j": "D",
    "%": "%", "F": "yyyy-MM-dd", "T": "HH:mm:ss", "x": "yyyy-MM-dd", "X": "HH:mm:ss",
}


def java_pattern(pattern: str) -> str:
    """``%d/%m/%Y`` as ``dd/MM/yyyy``; a pattern without percent signs as it is."""
    if "%" not in pattern:
        return pattern
    out, i, plain = [], 0, ""

    def flush() -> None:
        nonlocal plain
        if plain:
            out.append("'" + plain.replace("'", "''") + "'" if any(c.isalpha() for c in plain) else plain)
            plain = ""

    while i < len(pattern):
        if pattern[i] == "%":
            key = pattern[i + 1 : i + 3] if pattern[i + 1 : i + 2] == "-" else pattern[i + 1 : i + 2]
            if key not in _JAVA:
                raise ValueError(f"no Java form of %{key}")
            flush()
            out.append(_JAVA[key])
            i += 1 + len(key)
        else:
            plain += pattern[i]
            i += 1
    flush()
    return "".join(out)
