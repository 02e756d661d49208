"""Errors and the exit codes they lead to."""


class CorpusError(Exception):
    code = 2


class ConfigError(CorpusError):
    """A manifest, persona file or option is wrong."""


class GateError(CorpusError):
    """Retention, path or integrity."""

    code = 3


class UnsupportedError(CorpusError):
    """No parser for the profile, or not for its input type."""

    code = 4


class ParseFailure(CorpusError):
    code = 5
