from .search import Export, SearchResult, export, search
from .view import View

__all__ = ["Export", "SearchResult", "View", "export", "search"]
