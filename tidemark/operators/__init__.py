"""DataFrame operators: conform, archive, versions, manifest, gates."""
