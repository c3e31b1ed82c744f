"""Query plans over the star tables. Importing the package fills the registry."""
