"""How a delimited file is written down."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values.
BEL = "\u0007"
TYPED_TIMESTAMP_PATTERN = "yyyy-MM-dd:HH:mm:ss"


@dataclass(frozen=True)
class Dialect:
    """Reading and writing use the same dialect, so what is written can be read back."""

    sep: str = BEL
    quote: str = '"'
    escape: str = "\\"
    multiline: bool = False
    trim: bool = True
    infer: bool = False
    timestamp_format: str | None = None
    #: A record separator other than the line feed keeps files with embedded line feeds
    #: splittable, which ``multiline`` does not.
    record_sep: str | None = None

    def with_(self, **changes) -> Dialect:
        return replace(self, **changes)

    def _common(self) -> dict[str, str]:
        options = {"sep": self.sep, "quote": self.quote, "escape": self.escape}
        if self.timestamp_format:
            options["timestampFormat"] = self.timestamp_format
        if self.record_sep:
            options["lineSep"] = self.record_sep
        return options

    def read_options(self) -> dict[str, str]:
        trim = str(self.trim).lower()
        options = {
            **self._common(),
            "ignoreLeadingWhiteSpace": trim,
            "ignoreTrailingWhiteSpace": trim,
            "multiLine": str(self.multiline).lower(),
        }
        if self.infer:
            options["inferSchema"] = "true"
        return options

    def write_options(self) -> dict[str, str]:
        """Keeps blanks, which Spark would trim, and quotes an empty text as this dialect does."""
        return {
            **self._common(),
            "emptyValue": self.quote * 2,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }


BEL_DIALECT = Dialect()
#: Single quotes, doubled to escape.
APOSTROPHE_DIALECT = Dialect(quote="'", escape="'")
#: Quote characters are ordinary text.
UNQUOTED_DIALECT = Dialect(quote="")
#: Types are inferred, timestamps carry a colon between date and time.
TYPED_DIALECT = Dialect(escape="\r", infer=True, timestamp_format=TYPED_TIMESTAMP_PATTERN)
