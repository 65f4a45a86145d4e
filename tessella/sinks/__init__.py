"""Writers of annotation artifacts."""
