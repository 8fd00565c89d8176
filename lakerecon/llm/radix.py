"""An adaptive radix tree over byte strings: nodes of 4, 16, 48 or 256 children, with compressed paths."""

from __future__ import annotations

from collections.abc import Iterator


class Sorted:
    """Up to ``room`` children beside their sorted bytes."""

    def __init__(self, room: int, pairs: list[tuple[int, Node]]):
        self.room, self.bytes, self.nodes = room, bytearray(b for b, _ in pairs), [n for _, n in pairs]

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node):
        if len(self.bytes) == self.room:
            larger = Sorted(16, list(self.items())) if self.room == 4 else Indexed(self.items())
            return larger.put(byte, node)
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children; a table of 256 bytes says where, 0 is nowhere."""

    def __init__(self, pairs: Iterator[tuple[int, Node]]):
        self.places, self.nodes = bytearray(256), []
        for byte, node in pairs:
            self.put(byte, node)

    def get(self, byte: int) -> Node | None:
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: Node):
        if len(self.nodes) == 48:
            return Direct(self.items()).put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[at - 1]) for byte, at in enumerate(self.places) if at)


class Direct:
    """A place for each of 256 children."""

    def __init__(self, pairs: Iterator[tuple[int, Node]]):
        self.nodes: list[Node | None] = [None] * 256
        for byte, node in pairs:
            self.nodes[byte] = node

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node):
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node)


class Node:
    """``path`` is what all below have in common after the byte that leads here; ``rows`` end right behind it."""

    __slots__ = ("path", "children", "rows")

    def __init__(self, path: bytes, rows: list[int], children=None):
        self.path, self.rows, self.children = path, rows, children or Sorted(4, [])


class Tree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, row: int) -> None:
        """One row under its key; equal keys share a node."""
        if self.root is None:
            self.root = Node(key, [row])
            return
        node, depth = self.root, 0
        while True:
            if not key.startswith(node.path, depth):
                self._split(node, key, depth)
            depth += len(node.path)
            if depth == len(key):
                node.rows.append(row)
                return
            below = node.children.get(key[depth])
            if below is None:
                node.children = node.children.put(key[depth], Node(key[depth + 1 :], [row]))
                return
            node, depth = below, depth + 1

    def _split(self, node: Node, key: bytes, depth: int) -> None:
        """The path is cut where the key leaves it; what followed becomes the only child."""
        path, same = node.path, 0
        for ours, theirs in zip(path, key[depth:]):
            if ours != theirs:
                break
            same += 1
        lower = Node(path[same + 1 :], node.rows, node.children)
        node.path, node.rows, node.children = path[:same], [], Sorted(4, [(path[same], lower)])

    def postorder(self) -> Iterator[tuple[Node, int, int]]:
        """(node, bytes above its edge, bytes down to its end), children before parents and by their bytes."""
        stack = [(self.root, 0, False)] if self.root else []
        while stack:
            node, depth, seen = stack.pop()
            end = depth + len(node.path) + (node is not self.root)
            if seen:
                yield node, depth, end
            else:
                stack.append((node, depth, True))
                stack += [(child, end, False) for _, child in reversed(list(node.children.items()))]
