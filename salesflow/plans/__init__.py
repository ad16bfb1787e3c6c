"""User-level jobs: the reference's pipelines as parameterised functions
over many days at once (see ``jobs``)."""
