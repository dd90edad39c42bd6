"""Connected components of a table of links: the library's own, under the name this subpackage uses."""

from siltbed.operators.graph import components  # noqa: F401
