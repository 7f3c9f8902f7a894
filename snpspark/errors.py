"""Errors that callers may want to tell apart."""


class InputError(ValueError):
    """An input lacks something that it must have."""


class InvalidContigName(InputError):
    """A contig that isn't in the reference."""


class ReferenceCallMismatch(InputError):
    """An input's reference base isn't the reference's."""


class MalformedFile(InputError):
    """A file that isn't what its name or place says."""


class DuplicateSample(InputError):
    """The same sample in several inputs."""
