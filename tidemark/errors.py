"""Errors of the library; each also is the built-in error that a caller would expect."""


class TidemarkError(Exception):
    """Any error of the library that isn't a plain wrong argument."""


class ConfigError(TidemarkError, ValueError):
    """A configuration that can't be used."""


class IntegrityError(TidemarkError, RuntimeError):
    """What the engine relies on isn't there, or isn't what it should be."""


class PathError(TidemarkError, ValueError):
    """A path that leaves its root."""


class LoggingError(TidemarkError, RuntimeError):
    """A log that can't be written."""


class SourceError(TidemarkError, RuntimeError):
    """A source that didn't answer, or not with what was asked for."""
