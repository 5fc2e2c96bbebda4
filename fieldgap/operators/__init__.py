"""Generic operators; column names are parameters, frames go in and come out lazily."""
