"""barloom.operators"""
