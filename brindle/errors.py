"""Errors of the Arrow IPC and splay sources and sinks. Messages say which operation failed, and why."""


class ArrowIpcError(Exception):
    """Base of all errors of this package's columnar files."""

    def __init__(self, operation: str, problem: str, detail: str = ""):
        self.operation, self.problem, self.detail = operation, problem, detail
        super().__init__(f"{operation}: {problem}" + (f" ({detail})" if detail else ""))

    def __reduce__(self):
        return type(self), (self.operation, self.problem, self.detail)


class OpenError(ArrowIpcError):
    """A file can't be opened, or isn't a valid file of its format."""

    def __init__(self, operation: str, detail: str = "", problem: str = "open failed"):
        super().__init__(operation, problem, detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail, self.problem)


class UnsupportedColumn(ArrowIpcError):
    def __init__(self, operation: str, detail: str = ""):
        super().__init__(operation, "unsupported column type", detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail)


class CompressedBody(ArrowIpcError):
    def __init__(self, operation: str, detail: str = ""):
        super().__init__(operation, "compressed IPC body unsupported", detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail)


class BatchParseError(ArrowIpcError):
    def __init__(self, operation: str, detail: str = ""):
        super().__init__(operation, "batch parse failed", detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail)


class CreateError(ArrowIpcError):
    def __init__(self, operation: str, detail: str = ""):
        super().__init__(operation, "create failed", detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail)


class BadArgument(ArrowIpcError, TypeError):
    def __init__(self, operation: str, detail: str = ""):
        super().__init__(operation, "bad argument", detail)

    def __reduce__(self):
        return type(self), (self.operation, self.detail)
