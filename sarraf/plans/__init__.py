"""The layers: silver, staging, dimensions, facts, marts, serving."""
