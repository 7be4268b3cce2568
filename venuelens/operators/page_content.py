"""Fields of one HTML page. Standard library only, since it travels to the Python workers with the query."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser


@dataclass(frozen=True)
class Rule:
    """An element: its tag, and a text that one of its attributes holds."""

    tag: str
    attribute: str | None = None
    value: str = ""


# One element, or several to try in turn until one finds something.
Rules = Rule | tuple[Rule, ...]


@dataclass(frozen=True)
class PageRules:
    """Where the fields of a page are."""

    card: Rules
    user: Rules
    comment: Rules
    name: Rules = Rule("h1")
    rating: Rules | None = None
    review_count: Rules | None = None
    address: Rules | None = None
    label: Rule = Rule("svg")
    label_word: str = "bubble"


_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class _Node:
    tag: str
    attributes: dict[str, str]
    parent: "_Node | None" = None
    children: list["_Node | str"] = field(default_factory=list)

    def walk(self) -> Iterator["_Node"]:
        stack = [c for c in reversed(self.children) if isinstance(c, _Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))

    def find(self, rule: Rules | None) -> list["_Node"]:
        if rule is None:
            return []
        if isinstance(rule, tuple):
            return next((found for one in rule if (found := self.find(one))), [])
        return [
            n for n in self.walk()
            if n.tag == rule.tag and (rule.attribute is None or rule.value in n.attributes.get(rule.attribute, ""))
        ]

    def outermost(self, rule: Rules | None) -> list["_Node"]:
        """Like ``find``, without elements inside another one that is found."""
        nodes = self.find(rule)
        ids = {id(n) for n in nodes}

        def is_inside(node: "_Node") -> bool:
            up = node.parent
            while up is not None and up is not self:
                if id(up) in ids:
                    return True
                up = up.parent
            return False

        return [n for n in nodes if not is_inside(n)]

    def texts(self) -> list[str]:
        """Stripped, non-empty texts in document order."""
        found: list[str] = []
        stack: list[_Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                if item.strip():
                    found.append(item.strip())
            elif item.tag not in ("script", "style"):
                stack.extend(reversed(item.children))
        return found


class _Tree(HTMLParser):
    """A plain element tree; an end tag closes up to its nearest open element, a stray one is skipped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {})

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(_Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        children = self.at.children
        if children and isinstance(children[-1], str):
            children[-1] += data
        else:
            children.append(data)


def _first_text(nodes: list[_Node]) -> str | None:
    return next((t for n in nodes for t in n.texts()[:1]), None)


def _label(card: _Node, rules: PageRules) -> str | None:
    for node in card.find(rules.label):
        titles = [t for n in node.find(Rule("title")) for t in n.texts()]
        for text in (node.attributes.get("title"), node.attributes.get("aria-label"), *titles):
            if text:
                if rules.label_word in text.lower():
                    return text
                break
    return None


def page_fields(html: str, rules: PageRules) -> dict[str, object]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    page = tree.root
    cards = page.find(rules.card)
    reviews = []
    for card in cards:
        user = _first_text(card.find(rules.user))
        comment = "\n".join(t for n in card.outermost(rules.comment) for t in n.texts()) or None
        if user or comment:
            reviews.append({"user": user, "rating": _label(card, rules), "comment": comment})
    return {
        "name": _first_text(page.find(rules.name)),
        "rating": _first_text(page.find(rules.rating)),
        "review_count": _first_text(page.find(rules.review_count)),
        "address": _first_text(page.find(rules.address)),
        "cards": len(cards),
        "reviews": reviews,
    }
